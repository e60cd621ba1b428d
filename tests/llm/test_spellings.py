from pyspark.sql import functions as F

from noticelake.llm.spellings import attribute, entities, name_fit, same_names, shared, words

SCHEMA = "objectId string, organizationName string, contractors array<struct<contractorName:string,contractorNationalId:string>>, name string, root string"
GROUPS = [
    ["Szkoła Podstawowa nr 5 im. Nigukikomackiego w Kawiniów", "SP nr 5 im. Nigukikomackiego", "SZKOLA PODSTAWOWA Nr5 IM. NIGUKIKOMACKIEGO, KAWINIOW", "Kawiniów: Szkoła Podstawowa nr 5 im. Nigukikomackiego", "Szk. Pod. nr 5 im. Nigukikomakciego w Kawiniów"],
    ["Szkoła Podstawowa nr 15 im. Nigukikomackiego w Kawiniów", "Szkoła Podstawowa nr 15 imienia Nigukikomackiego  w Kawiniów "],
    ["Przedsiębiorstwo Produkcyjno-Handlowe DANAKOWIRAMED Sp. z o.o.", "P.P.H. „Danakowiramed”", "PPH Danakowiramed", 'Przedsiębiorstwo Produkcyjno-Handlowe "Danakowiramed" spółka z ograniczoną odpowiedzialnością', "Danakowiramed Sp. z o. o.", "Przedsiębioorstwo Produkcyjno-Handlowe Danakowiramed sp.z.o.o"],
    ["Usługi Geodezyjne Małgorzata Leporanuczyk", "Gosia Leporanuczyk usługi geodezyjne", "Usł. Geodezyjne M. Leporanuczyk", "F.U. Małgorzata Leporanuczyk (Usługi Geodezyjne)"],
    ["Zakład Stolarski Józef Leporanuczyk", "Leporanuczyk Józek - Zakład Stolarski"],
    ["Gmina Ala", "GMINA ALA"],
    ["Agencja Mienia Komunalnego Zorzyn"],
    ["Zarząd Inwestycji Regionalnych Zorzyn"],
    ["Ala Ma Kota " * 200],
]


def envelope(spark):
    data = [(str(k), n, None, "x", None) for g in GROUPS[::2] for n in g for k in range(9 - g.index(n))]
    data += [("c", None, [(n, "0000000000") for g in GROUPS[1::2] for n in g] + [(None, "1"), None, (" ", "1")], None, None), ("d", "…", [], None, None)]
    return spark.createDataFrame(data, SCHEMA)


def test_pairs(spark, rows):
    want = sorted({tuple(sorted((a, b))) for g in GROUPS for a in g for b in g if a != b})
    assert rows(same_names(envelope(spark))) == sorted(want, key=repr)


def test_entities_and_empty(spark, rows):
    e = {r.name: (r.canonical, r.n_spellings) for r in entities(envelope(spark)).collect()}
    assert e["PPH Danakowiramed"][1] == 6 and e["Gmina Ala"][1] == 2 and e["Agencja Mienia Komunalnego Zorzyn"] == ("Agencja Mienia Komunalnego Zorzyn", 1)
    assert same_names(envelope(spark).limit(0)).count() == 0


def test_common_words_still_link(spark, rows):
    people = ["".join(chr(97 + (k // 26**j + i * i * (k + 3)) % 26) for i, j in enumerate((0, 1, 0, 1, 0, 1, 0, 1, 0))) for k in range(450)]
    names = [f"Zakład Stolarski {p}" for p in people] + [f"Zakład Stolarski Elżbieta Leporanuczyk {k}" for k in range(90)] + [f"Zakład Ślusarski Marzena {p}" for p in people[:100]]
    whole, other = "Zakład Stolarski Elżbieta Leporanuczyk", "Zakład Stolarski Marzena Kwiatuszyńska"
    data = [(n, 2) for n in names] + [(whole, 999), ("Zkaład Stolarski Elżbieta Leporanuczyk", 1), (other, 9), ("Zakład Stolarski Marzena", 1)]
    root = dict(rows(attribute(spark.createDataFrame(data, "name string, freq bigint"))))
    assert root["Zkaład Stolarski Elżbieta Leporanuczyk"] == root[whole]
    assert root["Zakład Stolarski Marzena"] == root[other] == other


def test_links_stay_whatever_else_stands_in_the_table(spark):
    def links(others):
        names = ["Zakład Stolarski Józef Leporanuczyk", "Zakład Stolarski J. Leporanuczyk", "Z. Leporanuczyk", "Zakład Leporanuczyk", "PKP Z.U.K.", "PKP ZUK"]
        more = [f"Firma {a}{b}owa Leporanuczyk" for a in ("Bok", "Dal", "Fis", "Gor", "Hal", "Kum", "Mor", "Pyl", "Sut", "Tir") for b in ("ana", "ebo", "ici", "odu", "ufe", "aru", "eli", "ino", "ota", "uzy")][:others]
        t = spark.createDataFrame([(n, 2 if n.startswith("Zakład S") else 1) for n in names + more], "name string, freq bigint")
        got = {r.name: r.root for r in attribute(t).collect()}
        return {n: got[n] for n in names}

    few, many = links(3), links(100)
    assert few == many and few["Zakład Stolarski J. Leporanuczyk"] == "Zakład Stolarski Józef Leporanuczyk" == few["Z. Leporanuczyk"] == few["Zakład Leporanuczyk"]
    assert few["PKP ZUK"] == few["PKP Z.U.K."]


def test_every_candidate_that_explains_a_name_is_found(spark):
    import random

    rnd = random.Random(9)
    firsts, lasts, kinds = ["Jan", "Julia", "Kamil", "Karol", "J.", "K.", "Jn"], ["Kowalski", "Kowalska", "Nowak", "Nowacki", "Kubik", "K."], ["Zakład", "Zaklad", "Stolarnia", "Firma", "Z.", "F.", ""]
    names = sorted({" ".join(x for x in (rnd.choice(kinds), rnd.choice(firsts), rnd.choice(lasts)) if x) for _ in range(120)})
    t = spark.createDataFrame([(n, 1 + i % 5) for i, n in enumerate(names)], "name string, freq bigint")
    n = t.select("name", "freq", words(F.col("name")).alias("w"))
    a, b = n.select(*[F.col(c).alias(f"{c}s") for c in n.columns]), n.select(*[F.col(c).alias(f"{c}c") for c in n.columns])
    rank = lambda x: F.struct(F.size(f"w{x}"), F.col(f"freq{x}"), F.col(f"name{x}"))
    p = a.crossJoin(b).where(rank("c") > rank("s")).withColumn("fit", name_fit(F.col("ws"), F.col("wc"))).where(F.col("fit").isNotNull() & shared(F.col("ws"), F.col("wc")))
    p = p.where((F.size("ws") < F.size("wc")) | name_fit(F.col("wc"), F.col("ws")).isNotNull())
    best = {r.names: r.c for r in p.groupBy("names").agg(F.max_by("namec", F.struct(F.log("freqc") + F.col("fit"), F.col("freqc"), F.col("namec"))).alias("c")).collect()}

    def root(x):
        while x in best:
            x = best[x]
        return x

    assert {r.name: r.root for r in attribute(t).collect()} == {x: root(x) for x in names} and len(best) > 40


def test_a_word_of_a_candidate_stands_for_one_word(spark):
    cases = [
        ("Firma Transportowa FUFUZORAMATRANS", "F. Transp. „Fufuzoramatrans” Zorzyn", True),
        ("Firma Transportowa FALADASALATECH", "F. Transp. „Fufuzoramatrans” Zorzyn", False),
        ("Zakład Remontowo-Budowlany KUKEPEFOKOBUD", "Zakł. Rem.-Bud. „Kukepefokobud” oddział", True),
        ("Zakład Remontowo-Budowlany REMOSEGASABUD", "Zakł. Rem.-Bud. „Kukepefokobud” oddział", False),
        ("J. Kowalsky", "Jan Kowalski", True),
        ("K. Kowalsky", "Jan Kowalski", False),
        ("K. Kowalski", "Jan Kowalski", False),
        ("A. Hana Nowak", "Anna Hanna Nowak", True),
        ("PPH Dana", "Przedsiębiorstwo Produkcyjno-Handlowe Dana", True),
        ("Zakład Leporanuczyk", "Z. Stolarski Józef Leporanuczyk", True),
        ("Zakład Stolarski Zenobiusz Leporanuczyk", "Zakład Stolarski Z. Leporanuczyk Zorzyn", True),
        ("Usługi Geodezyjne M. Samatasupeczyk", "Usługi Geodezyjne S. Mokasabefocki", False),
        ("Kosofeboletech Zorzyn", "Usługi Geodezyjne K. Topeganagucka Zorzyn", False),
    ]
    t = spark.createDataFrame(cases, "a string, b string, fits boolean").select("a", "b", "fits", name_fit(words(F.col("a")), words(F.col("b"))).isNotNull().alias("got"))
    assert [(r.a, r.b) for r in t.collect() if r.got != r.fits] == []


def test_a_candidate_with_an_initial_does_not_gather_others(spark, rows):
    firms = [f"Firma Transportowa {x}" for x in ("FALADASALATECH", "FALUDAKEWUMED", "FANOLENOSOX", "FUFUZORAMATRANS")] + [f"Pracownia Projektowa Katarzyna {x}" for x in ("Kifozefekoczyk", "Kunatutowocka", "Dudokinutucka")]
    hubs = {"F. Transp. „Fufuzoramatrans” Zorzyn": "Firma Transportowa FUFUZORAMATRANS", "Pracownia Projektowa K. Dudokinutucka Zorzyn": "Pracownia Projektowa Katarzyna Dudokinutucka"}
    root = dict(rows(attribute(spark.createDataFrame([(n, 5) for n in firms] + [(h, 1) for h in hubs], "name string, freq bigint"))))
    assert all(root[h] == root[n] for h, n in hubs.items()) and len(set(root.values())) == len(firms)
