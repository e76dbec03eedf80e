"""Bare secrets in the forms they are written in, beside an access id."""

import pytest

from pulseloom.llm import secrets

IDS = ["AKIA" + "Q7" * 8, "ASIA" + "Z4" * 8]
BARE = "aB3/+xY9kL" * 4
SECRETS = [BARE, BARE + "aB3=", BARE + "Cd==", "aB3_-xY9kL" * 4 + "wXy", "aB3" * 10 + "Zz", "aB3/" * 21 + "Cd=="]
FORMS = ["AWS_SECRET_ACCESS_KEY={}", "export AWS_SECRET_ACCESS_KEY={}\n", "?id=1&sig={}&v=2", "key = {}", 'key="{}"',
         "key: {},", "{}"]


@pytest.mark.parametrize("form", FORMS)
def test_forms(spark, form):
    data = []
    for name in IDS:
        for secret in SECRETS:
            data.append((len(data), f"é {name}\n" + form.format(secret), name, secret))
    docs = spark.createDataFrame(data, "doc_id long, text string, name string, secret string")
    spans = {r.doc_id: r.spans.split(",") for r in secrets.report(docs.select("doc_id", "text")).collect()}
    masked = {r.doc_id: r.text for r in secrets.mask(docs).collect()}
    for i, text, name, secret in data:
        at = text.index(secret)
        assert f"secret:{at}:{at + len(secret)}" in spans[i], (text, spans[i])
        assert secret not in masked[i] and name not in masked[i]
        assert masked[i] == text.replace(secret, "[secret]").replace(name, "[secret]")


def test_no_secrets():
    """Neither names before '=', nor runs without all three kinds of characters, nor embedded data."""
    for text in ["Ab1" * 14 + "=value", "ab1" * 14, "Ab1" * 10, "Ab1" * 14 + "===", "Ab1" * 2000]:
        assert secrets.find(text)[1] == []
    assert secrets.find(f"k={BARE}")[0] == []  # base spans know nothing of it
