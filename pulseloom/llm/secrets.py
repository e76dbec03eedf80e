"""Secret scan with multipart credential linking.

Plain secrets are found by pattern. Weak parts (key ids, bare secret strings, endpoints)
mean nothing alone: they are reported only where complementary parts lie within reach.
Parts become rows; the reach of the complementary parts of a text is merged into disjoint
scopes, and an interval join (on text and position bin) finds the parts inside. Merged
scopes make at most one match per part, so no pairs multiply.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from pulseloom.llm import common

KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
REACH = 400  # code points between complementary parts
BIN = 1024
LONGEST = 1024  # bytes of a bare secret; longer runs are embedded data

_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{32,}")
_IDENT = re.compile(rb"(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}")
_NAMED = re.compile(rb"""(?:client|account|access|tenant)[_-]?(?:key[_-]?)?id["']?\x20*[:=]\x20*["']?([a-z0-9-]{8,})""")
# a leading '=' is a delimiter (KEY=VALUE), up to two trailing ones are padding
_SECRET = re.compile(rb"(?<![A-Za-z0-9/+_-])[A-Za-z0-9/+_-]{32,}+={0,2}(?![A-Za-z0-9/+_=-])")
_ENDPOINT = re.compile(rb"""https?://[^\x00-\x20"'<>]+""")


def find(text: str) -> tuple[list[tuple], list[tuple]]:
    """Base spans and weak parts of a text as (kind, start, end), in code points.

    Patterns are ASCII, so they run over UTF-8, lower-cased where either case counts.
    """
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    base = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(low) if len(m[2]) >= 8]
    base += [("access", m.start(), m.end()) for m in _ACCESS.finditer(raw) if len(m[0]) >= 16]
    base += [("hex", m.start(), m.end()) for m in _HEX.finditer(raw)]
    weak = [("ident", m.start(), m.end()) for m in _IDENT.finditer(raw)]
    weak += [("ident", *m.span(1)) for m in _NAMED.finditer(low)]
    weak += [("secret", m.start(), m.end()) for m in _SECRET.finditer(raw)
             if len(m[0]) <= LONGEST and re.search(rb"[0-9]", m[0]) and re.search(rb"[A-Z]", m[0]) and re.search(rb"[a-z]", m[0])]
    weak += [("endpoint", m.start(), m.end()) for m in _ENDPOINT.finditer(raw)]
    if len(raw) != len(text) and (base or weak):
        marks = sorted({p for _, s, e in base + weak for p in (s, e)})
        at, last, n = {}, 0, 0
        for p in marks:
            n += len(raw[last:p].decode("utf-8", "surrogatepass"))
            at[p], last = n, p
        base, weak = ([(k, at[s], at[e]) for k, s, e in spans] for spans in (base, weak))
    return base, sorted(set(weak))


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


_SCANNED = ("doc_id long, text_key string, n_assign long, n_access long, n_hex long, base_sha256 string, "
            "base string, parts array<struct<kind:string,start:int,end:int>>")


def _scan(frames):
    common.alone("secrets")
    for frame in frames:
        rows = []
        for doc_id, text in zip(frame["doc_id"].to_numpy(dtype=object), frame["text"]):
            base, weak = find(text)
            spans = _joined(base)
            count = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
            # without a weak part there is nothing to link
            key = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() if weak else None
            parts = [{"kind": k, "start": s, "end": e} for k, s, e in base + weak] if weak else None
            rows.append((doc_id, key, *count, hashlib.sha256(spans.encode()).hexdigest(), spans, parts))
        out = pd.DataFrame(rows, columns=["doc_id", "text_key", "n_assign", "n_access", "n_hex", "base_sha256",
                                          "base", "parts"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def scan(docs: DataFrame) -> DataFrame:
    """One staged row per document: base spans, and all parts where weak ones occur."""
    rows = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInPandas(_scan, _SCANNED)
    return common.staged(rows, common.run_dir(docs.sparkSession, "secrets"))


def _scopes(parts: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Disjoint scopes around the parts of these kinds, one row per position bin they touch."""
    near = parts.filter(F.col("kind").isin(*kinds)).select(
        "text_key", (F.col("start") - REACH).alias("lo"), (F.col("end") + REACH).alias("hi"))
    by_start = Window.partitionBy("text_key").orderBy("lo", "hi")
    before = F.max("hi").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opened = near.withColumn("opens", F.coalesce((F.col("lo") > before).cast("int"), F.lit(1)))
    numbered = opened.withColumn("scope", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("text_key", "scope").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return merged.select("text_key", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / BIN), F.floor(F.col("hi") / BIN))).alias("bin"))


def _inside(parts: DataFrame, scopes: DataFrame) -> DataFrame:
    """Interval join: the parts that overlap a scope, so of two parts each reaches the other or neither does."""
    bins = F.explode(F.sequence(F.floor(F.col("start") / BIN), F.floor(F.col("end") / BIN)))
    p, s = parts.withColumn("bin", bins).alias("p"), scopes.alias("s")
    held = ((F.col("p.text_key") == F.col("s.text_key")) & (F.col("p.bin") == F.col("s.bin"))
            & (F.col("p.start") <= F.col("s.hi")) & (F.col("p.end") >= F.col("s.lo")))
    return p.join(s, held, "left_semi").drop("bin").distinct()


def linked(scanned: DataFrame) -> DataFrame:
    """(text_key, kind, start, end) of the weak parts whose complements lie within reach.

    An ident needs a secret, a secret needs an access identifier, an endpoint needs both.
    Copies of a text are looked at once.
    """
    parts = (scanned.filter(F.col("text_key").isNotNull()).select("text_key", F.explode("parts").alias("p"))
             .select("text_key", "p.kind", "p.start", "p.end").distinct())
    access = _scopes(parts, ("access", "ident"))
    secret = _scopes(parts, ("assign", "hex", "secret"))
    kind = F.col("kind")
    return (_inside(parts.filter(kind == "ident"), secret)
            .unionByName(_inside(parts.filter(kind == "secret"), access))
            .unionByName(_inside(_inside(parts.filter(kind == "endpoint"), access), secret)))


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def report(docs: DataFrame) -> DataFrame:
    """Spans of every document, one row per input row.

    A null or empty text has no spans and the digest of the empty string. Ids may be null
    or repeat; each row stands for itself. Other columns are ignored; an empty table gives no rows.
    """
    scanned = scan(docs)
    by_text = linked(scanned).groupBy("text_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    told = F.split("base", ",")
    spans = F.transform(F.filter(told, lambda x: x != ""), lambda x: F.struct(
        F.split_part(x, F.lit(":"), F.lit(1)).alias("kind"),
        F.split_part(x, F.lit(":"), F.lit(2)).cast("int").alias("start"),
        F.split_part(x, F.lit(":"), F.lit(3)).cast("int").alias("end")))
    ordered = F.array_sort(F.transform(F.concat(spans, F.col("more")), lambda x: F.struct(
        x["start"].alias("start"), _rank(x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))))
    joined = F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    # only texts with weak parts take part in the join, so a hot null key moves nowhere
    plain = scanned.filter(F.col("text_key").isNull()).withColumn("spans", F.col("base"))
    weak = (scanned.filter(F.col("text_key").isNotNull()).join(by_text, "text_key", "left")
            .withColumn("spans", F.when(F.col("more").isNull(), F.col("base")).otherwise(joined)))
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    return plain.select(columns).unionByName(weak.select(columns))


@pandas_udf(StringType())
def _masked(text: pd.Series, more: pd.Series) -> pd.Series:
    out = []
    for value, extra in zip(text, more):
        if value is None:
            out.append(None)
            continue
        spans = sorted({(s, e) for _, s, e in find(value)[0]} | {(int(x["start"]), int(x["end"])) for x in
                                                                (extra if extra is not None else ())})
        last, pieces = 0, []
        for start, end in spans:
            if end > last:
                pieces += [value[last:max(start, last)], "[secret]" if start >= last else ""]
                last = end
        out.append("".join(pieces) + value[last:] if spans else value)
    return pd.Series(out, dtype=object)


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace every reported span by ``[secret]``; all rows and columns stay.

    A column ``n_chars`` follows the new text. A null text stays null, and so does its length.
    Repeated rows stay repeated. Other columns may have any name. An empty table stays empty.
    """
    by_text = linked(scan(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text")))).groupBy(
        F.col("text_key").alias("_key")).agg(F.collect_list(F.struct("start", "end")).alias("_more"))
    # the row as one value: its columns cannot clash with the helpers
    rows = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"))
    # the patterns of weak parts: texts without any skip the join
    weak = F.coalesce(F.col("_text"), F.lit("")).rlike(
        r"ASIA|AROA|AIDA|(?i:id[\"']?\x20*[:=])|https?://|[A-Za-z0-9/+_-]{32}")
    some = rows.filter(weak).withColumn("_key", F.sha2("_text", 256)).join(by_text, "_key", "left").drop("_key")
    rest = rows.filter(~weak).withColumn("_more", F.lit(None).cast("array<struct<start:int,end:int>>"))
    both = rest.unionByName(some).select("_row", _masked(F.col("_text"), F.col("_more")).alias("_text"))
    new = {text_col: F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return both.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
