"""Folding and field extraction against exact values and plain Python."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from folioaudit.functions import fields
from folioaudit.functions.folding import fold, fold_table
from folioaudit.functions.rules import RULES, with_rules
from folioaudit.operators.landing import clean_metadata


def evaluate(spark, rows, schema, *columns):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"row int, {schema}")
    found = df.select("row", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).collect()
    out = [tuple(r)[1:] for r in sorted(found, key=lambda r: r.row)]
    return [r[0] for r in out] if len(columns) == 1 else out


def python_fold(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def test_fold_exact(spark):
    text = "é ñ ﬁ ½ ™ ª ß ø — … №"
    want = "e n fi 12 TM a    ... No"
    assert evaluate(spark, [(text,), ("",), (None,), ("plain\r\n",)], "t string", fold(F.col("t"))) == [
        want, "", None, "plain\r\n",
    ]
    assert python_fold(text) == want


def test_fold_equals_python_on_whole_table_and_random_strings(spark):
    pick = random.Random(7)
    special = sorted(fold_table())
    other = [chr(c) for c in range(0x20, 0x7F)] + list("\n\t\r") + list("漢字한글́̃ßøЖ\U0001f600")
    texts = ["".join(special)]
    for _ in range(1500):
        pool = special if pick.random() < 0.3 else other + special[:200]
        texts.append("".join(pick.choice(pool) for _ in range(pick.randrange(0, 60))))
    assert evaluate(spark, [(t,) for t in texts], "t string", fold(F.col("t"))) == [python_fold(t) for t in texts]


def test_fold_equals_python_on_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for text, folded in docs.select("text", fold(F.col("text"))).collect():
        assert folded == python_fold(text)


def test_issuer(spark):
    cases = {
        "\nA.F.P. Otra\nwww.afphabitat.cl": "otra",
        "A.F.P. Modelo S.A.": "",
        "\n\n\nAFP  MODELO S.A.": "modelo",
        "visite www.AFPHABITAT.CL": "habitat",
        "\na.f.p. Uno": "uno",
        "": "",
    }
    assert evaluate(spark, [(t,) for t in cases], "t string", fields.detect_afp(F.col("t"))) == list(cases.values())


def test_rut(spark):
    cases = {
        "123.456.789-K": "23.456.789-K",
        "x 1.234.567-8 2.345.678-9": "1.234.567-8",
        "12.345.678-k": "12.345.678-k",
        "12345678-9": "",
    }
    assert evaluate(spark, [(t,) for t in cases], "t string", fields.extract_rut(F.col("t"))) == list(cases.values())


def test_codver(spark):
    cases = [
        ("capital", "Certificacion: ab|1", "ab|1"),
        ("modelo", "Folio x\ry: abc", "abc"),
        ("modelo", "Folio 1: x: Zz9", "Zz9"),
        ("habitat", "0A1B2C3D-aaaa-BBBB-cccc-0123456789ab", "0A1B2C3D-aaaa-BBBB-cccc-0123456789ab"),
        ("cuprum", "FOLIO No CU123", "123"),
        ("provida", "certificado:\x1c1.2|3", "1.2|3"),
        ("planvital", "folio 12-34", "12-34"),
        ("uno", "Certificacion N: a|9", "a|9"),
        ("otra", "Folio: abc", ""),
        ("", "Folio: abc", ""),
        ("uno", "nothing", ""),
    ]
    got = evaluate(spark, [c[:2] for c in cases], "a string, t string", fields.extract_codver(F.col("a"), F.col("t")))
    assert got == [c[2] for c in cases]


def test_patterns_equal_python(spark):
    pick = random.Random(11)
    words = ["Folio", "FOLIO", "certificado", "Certificacion:", "certificacion:", "N", "No", "CU12", ":", "cotizaciones",
             "de", "12.3|4", "1-2", "abc", " ", "\n", "\r", "\x1c", "\x0b", "\t", "x"]
    texts = ["".join(pick.choice(words) + pick.choice(["", " ", " "]) for _ in range(pick.randrange(1, 14))) for _ in range(2000)]
    for rule in RULES:
        hits = [re.search(rule.codver, t, re.IGNORECASE) for t in texts]
        want = [h.group(1) if h else "" for h in hits]
        got = evaluate(spark, [(t,) for t in texts], "t string", fields.extract_codver(F.lit(rule.afp), F.col("t")))
        assert got == want, rule.afp
    pattern = r"certificado(?:\s+\w+){0,2}\s+cotizaciones"
    want = [bool(re.search(pattern, t, re.IGNORECASE)) for t in texts]
    assert evaluate(spark, [(t,) for t in texts], "t string", fields.is_certificate(F.col("t"))) == want
    assert any(want)


def test_certificate(spark):
    cases = {
        "Certificado cotizaciones": True,
        "certificado de cotizaciones": True,
        "certificado de las COTIZACIONES": True,
        "certificado de las tres cotizaciones": False,
        "certificado\x1cde\x1fcotizaciones": True,
    }
    assert evaluate(spark, [(t,) for t in cases], "t string", fields.is_certificate(F.col("t"))) == list(cases.values())


def test_producer(spark):
    cases = [
        ("uno", "", False),
        ("uno", None, False),
        ("otra", "iText", None),
        ("", "iText", None),
        ("habitat", "iText1x3y1", True),
        ("habitat", "iText 2.1.7", False),
        ("habitat", "iText1\r3 1", True),
        ("provida", "itext 2", True),
        ("provida", "İTEXT", True),
        ("cuprum", "null", True),
    ]
    got = evaluate(spark, [c[:2] for c in cases], "a string, p string", fields.producer_matches(F.col("a"), F.col("p")))
    assert got == [c[2] for c in cases]


def test_rut_l11(spark):
    cases = {"1.234.567-8": "001234567-8", "": "", "1234567890123": "1234567890123", "12.345.678-9": "012345678-9"}
    assert evaluate(spark, [(t,) for t in cases], "t string", fields.rut_l11(F.col("t"))) == list(cases.values())


def test_clean_values(spark):
    rows = [(None, b"\xffA", b"AB", b""), ("x", None, "é".encode(), b"\xed\xa0\x80")]
    df = spark.createDataFrame(rows, "creator string, producer binary, creation_date binary, mod_date binary")
    got = {tuple(r) for r in clean_metadata(df).collect()}
    assert got == {("", "", "AB", ""), ("x", "", "é", "")}


def test_gate(spark):
    rows = [(True, "uno", "1", "c"), (False, "uno", "1", "c"), (True, "", "1", "c"), (True, "uno", "", "c"),
            (True, "uno", "1", ""), (None, "uno", "1", "c")]
    got = evaluate(spark, rows, "e boolean, a string, r string, c string",
                   fields.required_fields(F.col("e"), F.col("a"), F.col("r"), F.col("c")))
    assert got == [True, False, False, False, False, False]


def test_rule_lookup(spark):
    df = spark.createDataFrame([("uno",), ("otra",), ("",)], "afp string")
    got = {r.afp: r.producer_pattern for r in with_rules(df).collect()}
    assert got == {"uno": "Powered By Crystal", "otra": None, "": None}
