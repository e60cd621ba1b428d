import random

from noticelake.llm.canonical import country_aliases, errors, map_places, map_values, pigeonhole_join, town_aliases, town_forms
from pyspark.sql import functions as F

CITY = "city_id bigint, city_name string, province_code string"
COUNTRY = "country_id bigint, country_code string, country_code3 string, name_pl string, name_en string, name_native string"
ENV = "objectId string, organizationCity string, contractors array<struct<contractorName:string,contractorCity:string,contractorCountry:string>>, value string, kind string"


def osa(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_pigeonhole_join_finds_what_brute_force_finds(spark):
    rnd = random.Random(1)
    names = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(4, 12))) for _ in range(60)]

    def spoil(s):
        for _ in range(rnd.randint(0, 2)):
            i, k = rnd.randrange(max(1, len(s) - 1)), rnd.random()
            s = s[:i] + s[i + 1 : i + 2] + s[i : i + 1] + s[i + 2 :] if k < 0.3 else s[:i] + rnd.choice("abcde") + s[i + (k < 0.6) :] if k < 0.8 else s[:i] + s[i + 1 :]
        return s

    forms = sorted({spoil(n) for n in names * 3} - {""})
    got = {(r.form, r.ref_id): r.err for r in pigeonhole_join(spark.createDataFrame([("k", f) for f in forms], "kind string, form string"), spark.createDataFrame([("k", i, n) for i, n in enumerate(names)], "kind string, ref_id bigint, alias string")).collect()}
    want = {(f, i): e for f in forms for i, n in enumerate(names) if (e := osa(f, n)) <= 2}
    assert set(want) <= set(got) and all(got[k] == e for k, e in want.items())
    assert all(len(k[0]) == len(names[k[1]]) and sorted(k[0]) == sorted(names[k[1]]) for k in set(got) - set(want))  # two swaps that touch


def test_errors(spark):
    df = spark.createDataFrame([("abcdef", "abcdef"), ("bacdef", "abcdef"), ("badcef", "abcdef"), ("abxdyf", "abcdef"), ("bacdefx", "abcdef"), ("xyzdef", "abcdef")], "a string, b string")
    got = df.select(errors(F.col("a"), F.col("b"), F.levenshtein("a", "b"))).collect()
    assert [r[0] for r in got] == [0, 1, 2, 2, 2, None]


def test_places(spark, rows):
    cities = spark.createDataFrame([(1, "Labogoęcin", "PL02"), (2, "Kufupuyń Górny", "PL02"), (3, "Kufupuyń Mały", "PL02")], CITY)
    countries = spark.createDataFrame([(1, "PL", "POL", "Polska", "Poland", "Polska"), (2, "SK", "SVK", "Słowacja", "Slovakia", "Slovensko")], COUNTRY)
    c = lambda city, country: ("n", city, country)
    env = [
        ("a", "L a b o g o ę c i n", [c("gm. Laobgoecni", "Polsak"), None, c(" ", "PL"), c("Górny Kufupuyń", "Rzeczpospolita Polska")], None, None),
        ("b", "Labogoęcin", None, None, None), ("c", "01-234 Kufupuyń Grn.", [], "x", None), ("d", "Budaville", [c("Kufupuyń", "??"), c("KUFUPUYN MALY (os. Leśne)", "SK - Słowacja")], None, None), ("d", "Budaville", [], None, None), (None, "", None, None, None),
    ]
    got = map_places(spark.createDataFrame(env, ENV), cities, countries)
    assert rows(got) == sorted(
        [
            ("a", "contractorCity", 1, 1), ("a", "contractorCity", 4, 2), ("a", "contractorCountry", 1, 1), ("a", "contractorCountry", 4, 1), ("a", "organizationCity", 0, 1), ("c", "organizationCity", 0, 2),
            ("d", "contractorCity", 1, -1), ("d", "contractorCity", 2, 3), ("d", "contractorCountry", 1, -1), ("d", "contractorCountry", 2, 2), ("d", "organizationCity", 0, -1),
        ],
        key=repr,
    )
    assert map_places(spark.createDataFrame([], ENV), cities, countries).count() == 0
    assert map_places(spark.createDataFrame(env, ENV), cities.limit(0), countries.limit(0)).where("ref_id >= 0").count() == 0


def test_ties_are_unmatched_and_long_values_survive(spark, rows):
    values = spark.createDataFrame([("k", "abcx", ["abcx"], [], 2), ("k", "y" * 5000, ["y" * 5000], [], 2), ("k", "", [""], [], 2)], "kind string, value string, forms array<string>, words array<string>, most int")
    aliases = spark.createDataFrame([("k", 1, "abca"), ("k", 2, "abcb")], "kind string, ref_id bigint, alias string")
    assert {r.value[:4]: r.ref_id for r in map_values(values, aliases).collect()} == {"abcx": -1, "yyyy": -1, "": -1}


def test_aliases(spark, rows):
    assert rows(town_aliases(spark.createDataFrame([(2, "Kufupuyń Górny", "")], CITY))) == [(2, "gorny kufupuyn"), (2, "kufupuyn gor"), (2, "kufupuyn gorny"), (2, "kufupuyn grn")]
    assert country_aliases(spark.createDataFrame([(1, "PL", "POL", "Polska", None, "Polska")], COUNTRY)).count() == 3
    one = lambda v: spark.createDataFrame([(v,)], "v string").select(town_forms(F.col("v"))).first()[0]
    assert one(None) in (None, [None]) and one("Nalurosk, ul. Lipowa 34") == ["nalurosk"] and one("m. Nalurosk woj. x") == ["nalurosk"]
