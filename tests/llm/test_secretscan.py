"""Base spans against a plain reading of their rules, linking against all pairs."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from folioaudit.llm import secretscan as S


def plain(text):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return out + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]


PARTS = ["token", "PassWd", "secret", "api_key", "apikey", "ſecret", "toKen", "=", ": ", '"', "'", " ", "abcdef", "abc", "AKIA", "A" * 16, "0f" * 12, "é", "\n", "-/+."]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_base_equals_plain(parts):
    text = "".join(parts)
    assert sorted(S.base_spans(text)) == sorted(plain(text))


# The endpoints in one pattern, which is quadratic on long runs.
ENDPOINT = re.compile(r"""(?<![A-Za-z0-9])(?:[a-z][a-z0-9+.-]*://[^\s"'<>]+|(?:[a-z0-9-]+\.)+[a-z]{2,}:\d{2,5}(?!\d))""", re.I | re.A)


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from([*"ab1-.:/+ 80", "://", ":80", "a.bc:443", "http://", "é"]), max_size=24))
def test_endpoints_equal_the_pattern(parts):
    text = "".join(parts)
    assert S.endpoints_of(text) == [m.span() for m in ENDPOINT.finditer(text)]


def test_credentials_in_an_endpoint():
    text = f"db postgres://admin:{KEY}@db.example.com:5432/x here"
    assert linked(text) == ["admin", KEY, "db.example.com:5432/x"]
    assert linked(f"https://api.example.com/v1?key={KEY}") == ["https://api.example.com/v1", KEY]
    assert linked(f"redis://:{KEY}@cache.local/0") == [KEY, "cache.local/0"]
    assert linked("https://api.example.com/a@b?page=2") == [] == linked("ftp://bob@files.example.com/x")


def test_hostile_texts_take_seconds():
    import time

    for form in ("a-", "a.", "a", "1-", "0", "://", "a.b:80", "user=", "x://a:", "A1b2C3d4E5f6G7h8J9k0 ", "token" + " " * 50):
        text = form * (1_000_000 // len(form)) + " user=abc"
        began = time.perf_counter()
        S.linked_spans(text, S.base_spans(text))
        assert time.perf_counter() - began < 10, form


ID, KEY, PLACE = "user=alice42", "Zx81kQpL93mNv02Rt7Yb", "https://db.example.org/x"


def linked(text):
    return [text[s:e] for _, s, e in sorted(S.linked_spans(text, S.base_spans(text)), key=lambda x: x[1])]


def test_weak_parts_alone_are_not_reported():
    for text in (ID, KEY, PLACE, f"{ID} {PLACE}", f"{KEY} {KEY[::-1]}", ID + " " * 400 + KEY):
        assert linked(text) == []


def test_complementary_parts_are():
    assert linked(f"{ID} key {KEY}") == ["alice42", KEY]
    assert linked(f"{KEY}\n{PLACE}") == [KEY, PLACE]
    assert linked(f"{PLACE} {ID} {KEY}") == [PLACE, "alice42", KEY]
    # Strong matches complete weak ones.
    assert linked("AKIA" + "B" * 16 + f" {KEY}") == [KEY]
    assert linked(f"{ID} password: hunter22") == ["alice42"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([ID, KEY, PLACE, " " * 120, " words ", "token=abcdef99", "AKIA" + "C" * 20, "ab" * 14]), max_size=12))
def test_linking_equals_all_pairs(parts):
    text = " ".join(parts)
    base = S.base_spans(text)
    got = S.linked_spans(text, base)
    near = lambda a, b: b[0] <= a[1] + S.SCOPE and b[1] >= a[0] - S.SCOPE
    strong = [(s, e) for _, s, e in base]
    free = lambda m: not any(m[0] < e and m[1] > s for s, e in strong)
    ids = [m.span(1) for m in S.IDENTIFIER.finditer(text)]
    ends = [m.span() for m in ENDPOINT.finditer(text)]
    weak = [m.span() for m in S.BARE_SECRET.finditer(text) if free(m.span()) and m[0] == KEY and not any(s < m.end() and m.start() < e for s, e in ends)]
    weak = [w for w in weak if w not in ids]
    keys = weak + [(s, e) for k, s, e in base if k in ("assign", "hex") and (s, e) not in ids]
    all_ids = ids + [(s, e) for k, s, e in base if k == "access"]
    want = {("linked_identifier", *i) for i in ids if free(i) and any(near(i, k) for k in keys)}
    want |= {("linked_secret", *k) for k in weak if any(near(k, o) for o in all_ids + ends)}
    want |= {("linked_endpoint", *p) for p in ends if any(near(p, k) for k in keys)}
    assert set(got) == want and len(got) == len(want)


def test_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "é token = abcdef1", 5), (3, "é token = abcdef1", 5), (None, "AKIA" + "Z" * 16, 5), (4, "x " * 60_000 + "0f" * 20, 5)]
    out = S.secrets(spark.createDataFrame(rows, "doc_id int, text string, n_hex int"))
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == 6 and got[1]["spans"] == got[2]["spans"] == ""
    assert got[3]["spans"] == "assign:2:17" and got[4]["spans"] == "hex:120000:120040" and got[None]["n_access"] == 1
    assert got[1]["base_sha256"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert S.secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0
