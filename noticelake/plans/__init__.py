"""Named queries of the library: name -> DataFrame builder, and the SQL that gives the same rows."""
