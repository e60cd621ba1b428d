"""noticelake: declarative processing of semi-structured public notices on Spark."""
