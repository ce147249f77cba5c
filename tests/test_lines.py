"""The line difference against exact values and a brute-force multiset count."""

import random
from collections import Counter

from folioaudit.functions.lines import with_line_diff


def diff(spark, pairs):
    df = spark.createDataFrame([(i, v, o) for i, (v, o) in enumerate(pairs)], "i int, v string, o string")
    got = with_line_diff(df, "v", "o", "d").collect()
    return [r.d for r in sorted(got, key=lambda r: r.i)]


def brute_force(verified, original):
    """Unpaired copies of each line, the first copies being the paired ones."""
    out = []
    for side, (sign, mine, theirs) in enumerate((("-", verified, original), ("+", original, verified))):
        limit, seen = Counter(theirs.splitlines()), Counter()
        for at, line in enumerate(mine.splitlines()):
            seen[line] += 1
            if seen[line] > limit[line]:
                out.append((at, side, f"{sign} {line}"))
    return " | ".join(text for _, _, text in sorted(out))


def test_exact(spark):
    cases = [
        ("a\nb\nc", "a\nB x\nc", "- b | + B x"),
        ("a\nb\n", "a\nb", ""),
        ("a\nb\nc", "c\na\nb", ""),
        ("same", "same", ""),
        ("", "a\nb", "+ a | + b"),
        ("x\nx\nx", "x", "- x | - x"),
        ("a\r\nb\x0cc", "a\nb\nc", ""),
        ("\n", "", "- "),
        ("\n\n", "\n", "- "),
        (None, "a", None),
        ("a", None, None),
    ]
    assert diff(spark, [c[:2] for c in cases]) == [c[2] for c in cases]


def test_random_texts(spark):
    pick = random.Random(3)
    ends = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e"]
    pieces = ["a", "b", "", "c d", "a b"]

    def text():
        return "".join(pick.choice(pieces) + pick.choice(ends) for _ in range(pick.randrange(0, 12))) + pick.choice(["", "z"])

    pairs = [(text(), text()) for _ in range(1500)]
    assert diff(spark, pairs) == [brute_force(v, o) if v != o else "" for v, o in pairs]


def test_long_text_with_one_hot_line(spark):
    verified = "\n".join(["hot"] * 20000 + [str(n) for n in range(5000)])
    original = "\n".join(["hot"] * 19998 + [str(n) for n in range(5000)] + ["new"])
    assert diff(spark, [(verified, original)]) == [brute_force(verified, original)]
