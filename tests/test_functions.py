"""Golden tests of the scalar functions (titles, URLs, keys, JSON features)."""

from pyspark.sql import functions as F

from elcorpus.functions import (
    cache_key, decode_entities, entity_type, is_main_ns_title, is_main_ns_url, normalize_title,
    wikipedia_description, wikipedia_url,
)
from elcorpus.functions.wikidata import is_instance_of, p31_ids, parse_item
from elcorpus.profile import MEDIAWIKI_FR


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_namespace_prefixes_are_minimal():
    p = MEDIAWIKI_FR.ns_prefixes
    assert len(p) == 24
    assert "projet" in p and "cat%c3%a9gorie" in p and "discussion" in p


def test_main_ns_titles(spark):
    samples = {1: "Paris", 2: "  Tour Eiffel ", 3: "Projet Manhattan", 4: "Projet:Math", 5: "Paris#Histoire",
               6: "Discussion utilisateur:A", 7: "MODULE lunaire", 8: "A/B & C+D~*", 9: "L'Assommoir (roman)",
               10: "Cours"}
    df = spark.createDataFrame(list(samples.items()), "id int, t string")
    ok = sorted(r.id for r in df.filter(is_main_ns_title(F.col("t"))).collect())
    assert ok == [1, 2, 8, 9, 10]


def test_main_ns_urls(spark):
    samples = {1: "/wiki/Paris", 2: "/wiki/Mod%C3%A8le:X", 3: "/wiki/", 4: "/w/index.php?title=X",
               5: "/wiki/Paris#H", 6: "https://fr.wikipedia.org/wiki/Fichier:A.jpg", 7: "/WIKI/Lyon",
               8: "/wiki/D%C3%A9finition_de_gadget:Z"}
    df = spark.createDataFrame(list(samples.items()), "id int, u string")
    assert sorted(r.id for r in df.filter(is_main_ns_url(F.col("u"))).collect()) == [1, 7]


def test_url_quoting(spark):
    assert one(spark, wikipedia_url, "L'Été (film)") == "https://fr.wikipedia.org/wiki/L%27%C3%89t%C3%A9_%28film%29"
    assert one(spark, wikipedia_url, "A/B & C+D~*") == "https://fr.wikipedia.org/wiki/A/B_%26_C%2BD~%2A"


def test_normalize_and_strip(spark):
    assert one(spark, normalize_title, "  Tour Eiffel\t") == "Tour_Eiffel"


def test_description(spark):
    assert one(spark, wikipedia_description, "a\n\nb") == "a"
    assert one(spark, wikipedia_description, "a") == "a"
    assert one(spark, wikipedia_description, "") == ""


def test_cache_key(spark):
    assert one(spark, cache_key, "L'Été: «x»?") == "LEtex"
    assert one(spark, cache_key, "Œuvre/ß") == "OEuvress"


def test_entity_decoding_single_pass(spark):
    assert one(spark, decode_entities, "&amp;lt; &lt; &#233;&#xE9;&eacute; &bogus; &") == "&lt; < ééé &bogus; &"


def _type_of(spark, line):
    df = spark.createDataFrame([(line,)], "line string").select(parse_item(F.col("line")).alias("it"))
    return df.select(entity_type(F.col("it")).alias("t"), p31_ids(F.col("it")).alias("ids")).first()


def test_p31_order_rule(spark):
    # a claim without an id stops the instance test; an earlier hit still wins
    person = ("Q5", "Q1114461")
    df = spark.createDataFrame([(["x", None, "Q5"],), ([None, "Q5"],), (["Q5", None],), (["Q1", "Q5"],)], "ids array<string>")
    got = [r[0] for r in df.select(is_instance_of(F.col("ids"), person)).collect()]
    assert got == [False, False, True, True]


def test_type_precedence(spark):
    line = '{"type":"item","id":"Q1","labels":{},"descriptions":{},"aliases":{},"claims":{"P569":[],"P625":[]}}'
    assert _type_of(spark, line).t == "PERSON"
    line = '{"type":"item","id":"Q1","labels":{},"descriptions":{},"aliases":{},"claims":{"P31":[{"mainsnak":{"datavalue":{"value":{"id":"Q577"}}}}],"P569":[]}}'
    assert _type_of(spark, line).t == "DATE"
    line = '{"type":"item","id":"Q1","labels":{},"descriptions":{},"aliases":{},"claims":[]}'
    assert _type_of(spark, line).t == "OTHER"


def test_cache_key_folds_many_scripts(spark):
    from elcorpus.functions.ascii_fold import fold_char, to_ascii
    from pyspark.sql import functions as F
    cases = {"Iași Việt Łódź": "Iasi Viet Lodz", "Ελλάδα Ψυχή": "Ellada Psukhe", "Хрущёв Юрий Щука Київ": "Khrushchiov Iurii Shchuka Kiyiv",
             "서울 한국어": "seoul hangugeo", "さくら カタカナ": "sakura katakana", "Ⅷ ½ ﬁn Ａｂ ²": "VIII 1/2 fin Ab 2", "東京 😀": "東京 😀",
             "été": "ete", "Þór ßẞ Æther": "Thor ssSs AEther", "plain | text": "plain | text", "": ""}
    df = spark.createDataFrame(list(cases.items()) + [(None, None)], "t string, want string")
    for r in df.select("t", "want", to_ascii(F.col("t")).alias("got")).collect():
        assert r["got"] == r["want"]
    every = "".join(chr(cp) for cp in (*range(0x80, 0x530), *range(0x1D00, 0x3100), *range(0xAC00, 0xAD00), *range(0xFF00, 0xFFF0)))
    got = spark.createDataFrame([(every,)], "t string").select(to_ascii(F.col("t"))).first()[0]
    assert got == "".join(map(fold_char, every))
