"""Verdicts, payloads, base64 and request keys."""

import base64
import random

from pyspark.sql import functions as F

from folioaudit.functions import keys
from folioaudit.functions import payload as P

from .test_text import evaluate

def json():
    return P.parse(F.col("b"))


def verdicts(spark, bodies, column):
    return evaluate(spark, [(b,) for b in bodies], "b string", column)


def test_habitat(spark):
    good = ["0", "0.0", "false", "-0", "0e3"]
    bad = ['"0"', "1", "null", "true", "[0]", "{}"]
    bodies = [f'{{"resultado": {v}}}' for v in good + bad] + ["{}", "no json", "[1]", "", None]
    assert verdicts(spark, bodies, P.habitat_accepts(json())) == [True] * len(good) + [False] * (len(bad) + 5)
    bodies = ['{"mensaje":"/a"}', "{}", '{"mensaje":null}', '{"mensaje":3}', "[]"]
    assert verdicts(spark, bodies, P.habitat_path(json())) == ["/a", "", None, None, None]


def test_provida(spark):
    assert verdicts(spark, ["x", " ", "", None], P.provida_accepts(F.col("b"))) == [True, True, False, False]


def test_uno(spark):
    bodies = ['{"codigo":"0"}', '{"codigo":0}', '{"codigo":"1"}', '{"codigo":null}', "{}", "x", "[]"]
    assert verdicts(spark, bodies, P.uno_accepts(json())) == [True] + [False] * 6
    bodies = ['{"data":{"bytes":"QQ=="}}', "{}", '{"data":{}}', '{"data":null}', '{"data":{"bytes":null}}',
              '{"data":{"bytes":1}}', '{"data":[]}', '{"data":"x"}']
    assert verdicts(spark, bodies, P.uno_payload(json(), F.col("b"))) == ["QQ==", "", "", None, None, None, None, None]


def test_planvital(spark):
    good = ["true", "1", '"false"', "2.5", "[0]", "[null]", '{"a":null}', "-1", "1e300"]
    bad = ["false", "0", '""', "null", "[]", "{}", "0.0"]
    bodies = [f'{{"valid": {v}}}' for v in good + bad] + ["{}", "x", "[true]"]
    assert verdicts(spark, bodies, P.planvital_accepts(json())) == [True] * len(good) + [False] * (len(bad) + 3)
    bodies = ['{"data":"QQ=="}', "{}", '{"data":null}', '{"data":5}']
    assert verdicts(spark, bodies, P.planvital_payload(json(), F.col("b"))) == ["QQ==", "", None, None]


def python_base64(text):
    try:
        return base64.b64decode(text.encode())
    except ValueError:
        return None


def test_base64_equals_python(spark):
    pick = random.Random(5)
    texts = ["QU*JD", "QUJ", "", "QUJD=", "QQ==QQ==", "Q=Q=", "QQ=A", "====", "QR==", "Q", "QUI=", "é QQ=="]
    for _ in range(2000):
        texts.append("".join(pick.choice("ABab01+/=*\n") for _ in range(pick.randrange(0, 14))))
    got = evaluate(spark, [(t,) for t in texts], "b string", P.decode_base64(F.col("b")))
    assert [None if g is None else bytes(g) for g in got] == [python_base64(t) for t in texts]


def test_base64_of_long_payload(spark):
    raw = random.Random(1).randbytes(400_000)
    got = evaluate(spark, [(base64.b64encode(raw).decode(),)], "b string", P.decode_base64(F.col("b")))
    assert bytes(got[0]) == raw


def test_base64_takes_time_in_proportion(spark):
    """A sign every five characters, a megabyte of them: each is skipped."""
    import time

    text = "QUJD=" * 200_000
    df = spark.createDataFrame([(text,)], "b string").select(F.length(P.decode_base64(F.col("b"))).alias("n"))
    df.collect()
    began = time.perf_counter()
    assert df.first().n == 600_000
    assert time.perf_counter() - began < 3


def test_payloads_have_no_length_limit(spark):
    """Twenty million characters and more, which variants refuse."""
    for size in (19_999_996, 20_000_004):
        text = "QUJD" * (size // 4)
        rows = [(f'{{"codigo":"0","n":"a\\"b","data":{{"bytes":"{text}"}}}}', f'{{"valid":true,"data":"{text}"}}')]
        df = spark.createDataFrame(rows, "u string, p string")
        u, p = P.parse(F.col("u")), P.parse(F.col("p"))
        got = df.select(
            P.uno_accepts(u).alias("a"),
            P.planvital_accepts(p).alias("b"),
            F.xxhash64(P.uno_payload(u, F.col("u"))).alias("c"),
            F.xxhash64(P.planvital_payload(p, F.col("p"))).alias("d"),
            F.xxhash64(F.lit(text[:4])).alias("e"),
            F.length(P.uno_payload(u, F.col("u"))).alias("n"),
        ).first()
        want = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t")).first()[0]
        assert (got.a, got.b, got.c, got.d, got.n) == (True, True, want, want, size)


def test_last_duplicate_key_counts(spark):
    bodies = ['{"codigo":"1","codigo":"0"}', '{"codigo":"0","codigo":"1"}']
    assert verdicts(spark, bodies, P.uno_accepts(json())) == [True, False]


def test_one_reader_at_every_length(spark):
    """Verdicts don't hang on the body's length: short, and beyond what the reader's defaults allow."""
    numbers = "[" + ",".join(map(str, range(800))) + "]"
    key, path = "k" * 3000, "/" + "m" * 2500
    cases = [
        (f'{{"valid":{numbers},"resultado":{numbers}', True, False),
        (f'{{"{key}":1,"valid":"x","resultado":0.0', True, True),
        ('{"valid":0,"valid":1,"resultado":1,"resultado":0', True, True),
        ('{"valid":1,"valid":[],"resultado":0,"resultado":[0]', False, False),
    ]
    for size in (4, 20_000_400):
        filler = F.concat(F.lit(f',"mensaje":"{path}","data":"'), F.repeat(F.lit("A"), size), F.lit('"}'))
        for tail, good in (("", True), (" \n", True), (" x", False), ("{}", False), (",1", False), ('],["x"', False), ("}", False)):
            rows = cases if good and not tail or size == 4 else cases[1:2]
            df = spark.createDataFrame([(b,) for b, _, _ in rows], "b string").select(F.concat("b", filler, F.lit(tail)).alias("b"))
            df = df.withColumn("j", P.parse(F.col("b")))
            got = df.select(
                P.planvital_accepts(F.col("j")), P.habitat_accepts(F.col("j")), P.habitat_path(F.col("j")),
                F.length(P.planvital_payload(F.col("j"), F.col("b"))),
            ).collect()
            want = [(v and good, h and good, path if good else None, size if good else None) for _, v, h in rows]
            assert [tuple(r) for r in got] == want, (size, tail)


def test_only_json_is_read(spark):
    """As strict as the standard library, but for NaN and Infinity, which are no JSON."""
    import json as standard

    bodies = ["{}", " [1] ", "{'a':1}", "{a:1}", '{"a":1,}', '{"a":01}', "NaN", '{"a":Infinity}', '{"a":"\t"}', "/**/{}", "{} {}", "1 2", "1", '"x"', "tru", ""]
    bodies += ['{"a":' + "1" * 2000 + "}", '{"a":1e400}', "\ufeff{}", '{"a":"\\x"}', '{"a":"\\u00e9"}']

    def read(text):
        try:
            standard.loads(text, parse_constant=lambda _: [][0])
        except (ValueError, IndexError):
            return False
        return True

    assert verdicts(spark, bodies, json().isNotNull()) == [read(b) for b in bodies]


def test_status(spark):
    assert evaluate(spark, [(200,), (404,), (None,)], "s int", P.http_ok(F.col("s"))) == [True, False, False]


def test_request_keys(spark):
    good = "AB1CD-EF2GH-IJ3KL-MN4OP-7"
    cases = [
        ("provida", "1.234.567-K", "12.34.5", "12345-1234567K"),
        ("uno", "1.234.567-K", "a|b", "1234567K:a|b"),
        ("planvital", "1.234.567-K", "12-34", "1234:1234567K"),
        ("habitat", "1.234.567-K", "x-y", "x-y"),
        ("modelo", "1.234.567-K", "xy", "1.234.567-K:xy"),
        ("cuprum", "1.234.567-K", "CU12CUcu", "1.234.567-K:12cu"),
        ("capital", "1", good, good.replace("-", ":")),
        ("capital", "1", good + "9-tail", good.replace("-", ":")),
        ("capital", "1", good.lower(), None),
        ("capital", "1", "x" + good, None),
        ("capital", "1", good[:-1], None),
        ("otra", "1", "2", None),
    ]
    got = evaluate(spark, [c[:3] for c in cases], "a string, r string, c string",
                   keys.request_key(F.col("a"), F.col("r"), F.col("c")))
    assert got == [c[3] for c in cases]
