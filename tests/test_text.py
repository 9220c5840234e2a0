import random
import re
import sys
import unicodedata

import pytest

import kindred as kd
from pyspark.sql import functions as F

from kindred import country_key, lei_overlap, lei_set, name_key
from kindred.functions.text import COUNTRY_ALIASES, LEGAL_FORMS, _shorten_forms, _words_only, ascii_fold, normalise

NAMES = {
    "SpareBank 1 Nord-Norge (OB:NONG)": "sparebank 1 nord norge",
    "«International Bank»": "international bank",
    "ECOBANK-Mali": "ecobank mali",
    "Société Générale": "societe generale",
    "NORDEA  BANK": "nordea bank",
    "Banque X Société Anonyme": "banque x sa",
    "Open Joint Stock Company Y": "ojsc company y",
    "B.C. MAIB": "b c maib",
    "Sønderborg": "snderborg",
    "Public Joint-Stock Z": "pjsc z",
    "Public Joint－Stock Z": "pjsc z",
    "joint  stock company": "joint stock company",
    "A–B": "ab",
    "L'Avenir": "l avenir",
    "Crédit “Agricole”": "credit agricole",
    "a-b-c_d-e": "a b c d e",
    "ﬁrst ½ bank №5": "first 12 bank no5",
    "Bank (NYSE:BRK.A) Ltd": "bank ltd",
    "Bank (nyse:x)": "bank nyse x",
    "Gesellschaft mit beschränkter Haftung": "gesellschaft mit beschrankter haftung",
    None: "",
    "": "",
    "工商银行": "",
}
COUNTRIES = {
    "Bosnia & Herzegovina": "bosnia and herzegovina",
    "Bosnia and Herzegovina": "bosnia and herzegovina",
    "Côte d'Ivoire": "cote d ivoire",
    "Cote d'Ivoire": "cote d ivoire",
    "Côte d’Ivoire": "cote divoire",
    "Türkiye": "turkey",
    "Viet Nam": "vietnam",
    "Dem. Rep. Congo": "democratic republic of the congo",
    "Rep. Of the Congo": "republic of the congo",
    "Central African Rep.": "central african republic",
    "Gambia": "the gambia",
    "The Gambia": "the gambia",
    "Taiwan (Province of China)": "taiwan",
    "Palestine, State of": "palestine",
    "Korea, Republic of": "south korea",
    "USA": "united states",
    "U.S.A.": "u s a",
    "Timor-Leste": "timor leste",
    "East Timor": "timor leste",
    "  France\t": "france",
    None: "",
    "中国": "",
}
LEIS = {"A | B": ["A", "B"], "A|": ["A"], "a|A": ["a", "A"], " x |\tx ": ["x"], "|": [], " ": [], None: []}


def column_of(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, v string").orderBy("i")


def test_names(spark):
    got = column_of(spark, NAMES).select(name_key(F.col("v"))).collect()
    assert [r[0] for r in got] == list(NAMES.values())


def test_legal_forms_apply_in_order(spark):
    texts = [f"X {phrase.upper()} Y" for phrase, _ in LEGAL_FORMS]
    got = [r[0] for r in column_of(spark, texts).select(name_key(F.col("v"))).collect()]
    want = [f"x {short} y" for _, short in LEGAL_FORMS]
    assert got == want


def test_overlapping_forms(spark):
    """The single scan equals applying the rules in order, whatever words meet."""
    rng = random.Random(4)
    words = sorted({w for phrase, _ in LEGAL_FORMS for w in phrase.split()} | {"x"})
    texts = [" ".join(rng.choice(LEGAL_FORMS)[0] if rng.random() < 0.4 else rng.choice(words) for _ in range(6)) for _ in range(3000)]

    def in_order(text):
        for phrase, short in LEGAL_FORMS:
            text = re.sub(rf"\b{phrase}\b", short, text)
        return text.replace("-", " ")

    got = [r[0] for r in column_of(spark, texts).select(_words_only(_shorten_forms(F.col("v")))).collect()]
    assert got == [in_order(t) for t in texts]


def test_countries(spark):
    got = column_of(spark, COUNTRIES).select(country_key(F.col("v"))).collect()
    assert [r[0] for r in got] == list(COUNTRIES.values())


def test_aliases_are_final():
    assert not set(COUNTRY_ALIASES.values()) & set(COUNTRY_ALIASES)


def test_steps_equal_expression(spark):
    values = [*NAMES, *COUNTRIES]
    df = column_of(spark, values).select("i", F.col("v").alias("n"), F.col("v").alias("c"), "v")
    rows = normalise(df, "n", "c").select("n", "c", name_key(F.col("v")), country_key(F.col("v"))).collect()
    assert all(r[0] == r[2] and r[1] == r[3] for r in rows)


def test_leis(spark):
    got = column_of(spark, LEIS).select(lei_set(F.col("v"))).collect()
    assert [sorted(r[0]) for r in got] == [sorted(v) for v in LEIS.values()]


@pytest.mark.parametrize(
    "left,right,want",
    [("A | B", "B", True), ("A", "a", False), (None, "A", False), ("A", None, False), ("|", "|", False)],
)
def test_lei_overlap(spark, left, right, want):
    df = spark.createDataFrame([(left, right)], "l string, r string")
    assert df.select(lei_overlap(F.col("l"), F.col("r"))).first()[0] is want


def test_fold_every_character(spark):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    # In blocks of 64, each character between markers, to keep the row count small.
    blocks = ["".join(f"<{c}>" for c in chars[i : i + 64]) for i in range(0, len(chars), 64)]
    fold = lambda s: "".join(c for c in unicodedata.normalize("NFKD", s) if ord(c) < 128)
    want = ["".join(f"<{fold(c)}>" for c in chars[i : i + 64]) for i in range(0, len(chars), 64)]
    got = [r[0] for r in column_of(spark, blocks).select(ascii_fold(F.col("v"))).collect()]
    assert got == want


def test_control_characters_part_words(spark):
    names = {"alpha\x01corporation": "alpha corp", "alpha\x02corporation": "alpha corp", "corpo\x01ration": "corpo ration",
             "a\x01corporation\x01b": "a corp b"}
    df = spark.createDataFrame([(k,) for k in names], "name string")
    got = {r.name: r.key for r in kd.normalise(df.selectExpr("name", "name as key"), "key", None).collect()}
    assert got == names
