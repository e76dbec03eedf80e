"""Reach between parts, whichever comes first."""

import pytest

from pulseloom.llm import secrets

IDENT = "ASIA" + "Z4" * 8
BARE = "aB3/+xY9kL" * 4


def told(ident, secret, gap, first):
    a, b = (secret, ident) if first == "secret" else (ident, secret)
    return f"{a}{' ' * gap}{b}", (0, len(a)), (len(a) + gap, len(a) + gap + len(b))


@pytest.mark.parametrize("secret", [BARE, "aB3/+xY9kL" * 100])
def test_both_or_neither(spark, secret):
    cases = [(gap, first) for gap in (1, 355, 360, 361, 380, 399, 400, 401, 440) for first in ("secret", "ident")]
    texts = [told(IDENT, secret, *case) for case in cases]
    # the same where parts lie across the borders of bins
    shifts = [0, 620, 1000, 1023, 1024]
    data = [(i * 10 + k, "." * s + " " * (s > 0) + t[0]) for i, t in enumerate(texts) for k, s in enumerate(shifts)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.report(docs).collect()}
    for i, ((gap, first), (_, one, two)) in enumerate(zip(cases, texts)):
        kinds = ("secret", "ident") if first == "secret" else ("ident", "secret")
        for k, s in enumerate(shifts):
            at = s + (s > 0)
            expected = [f"{kind}:{a + at}:{b + at}" for kind, (a, b) in zip(kinds, (one, two))]
            assert got[i * 10 + k] == (",".join(expected) if gap <= secrets.REACH else ""), (gap, first, s)
