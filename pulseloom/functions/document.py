"""Reading keys of a JSON message.

``Keys`` names the top-level keys a caller needs; ``Keys.read`` parses each payload
once and adds just those, each as a VARIANT column, called a node here. Presence, JSON null and value are
three different things: a node is SQL NULL only when its key is absent, and a JSON
null stays a variant null. ``coalesce`` over nodes is therefore "first key present".

Converting a node that does not convert costs an exception inside the engine, so
conversions are only asked for where they normally succeed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Text of values that are false in a truth test although they are present.
_FALSY_TEXT = ("0", "0.0", "false", "[]", "{}")

# Only standard JSON; unlisted keys are skipped without being built.
_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
            "columnNameOfCorruptRecord": "_bad"}


class Keys:
    """Top-level keys read from a payload, one column per key."""

    def __init__(self, *keys: str):
        # own column names: device keys hold spaces and may differ only in case
        self._names = {key: f"_k{i}" for i, key in enumerate(dict.fromkeys(keys))}

    def _struct(self, by_key: bool) -> str:
        names = [f"`{k}`" for k in self._names] if by_key else self._names.values()
        return ", ".join(f"{name}{' ' if by_key else ':'}variant" for name in names)

    def read(self, raw: DataFrame, whole_text: bool = False) -> DataFrame:
        """Add the nodes and ``_is_json``, whether the text is one JSON object.

        ``whole_text`` also refuses anything after the object. The text is then read
        as the only element of an array; only ``_is_json`` tells that it was refused.

        Exploding a one-element array is a fence: Catalyst would otherwise copy the
        parse into every filter pushed below the projection and run it many times.
        """
        if not whole_text:
            doc = F.from_json("payload", self._struct(True) + ", _bad string", _OPTIONS)
            fenced = raw.select("*", F.explode(F.array(
                doc.cast(f"struct<{self._struct(False)}, _bad:string>"))).alias("_doc"))
            found = F.expr("_doc IS NOT NULL AND _doc._bad IS NULL")
        else:
            text = F.concat(F.lit("["), F.col("payload"), F.lit("]"))
            docs = F.from_json(text, f"array<struct<{self._struct(True)}>>", _OPTIONS)
            fenced = raw.select("*", F.explode(F.array(
                docs.cast(f"array<struct<{self._struct(False)}>>"))).alias("_docs"))
            fenced = fenced.withColumn("_doc", F.get("_docs", F.lit(0)))
            found = F.expr(
                "coalesce(size(_docs) = 1 AND _doc IS NOT NULL AND endswith(rtrim(payload), '}'), false)")
        return fenced.select("*", found.alias("_is_json"), "_doc.*").drop("_docs", "_doc", "_bad")

    def __getitem__(self, key: str) -> Column:
        return F.col(self._names[key])

    def first_present(self, *keys: str) -> Column:
        """The first key that exists, even when its value is JSON null."""
        return F.coalesce(*[self[k] for k in keys])

    def drop(self, df: DataFrame) -> DataFrame:
        """The frame without what ``read`` added."""
        return df.drop("_is_json", *self._names.values())


def child(parent: Column, *keys: str) -> Column:
    """The first of these keys that a node has."""
    return F.coalesce(*[F.try_variant_get(parent, f"$['{key}']", "variant") for key in keys])


def fence(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns behind the same fence, so later filters reuse their values."""
    packed = F.struct(*[value.alias(name) for name, value in columns.items()])
    rows = df.withColumn("_packed", packed).withColumn("_row", F.explode(F.array("_packed")))
    return rows.select("*", "_row.*").drop("_packed", "_row")


def kind(node: Column) -> Column:
    """Type name of a node: STRING, BIGINT, DOUBLE, BOOLEAN, VOID, OBJECT<...>, ..."""
    return F.schema_of_variant(node)


def has_value(node: Column) -> Column:
    """Present and not JSON null."""
    return node.isNotNull() & ~F.is_variant_null(node)


def is_text(node: Column) -> Column:
    return F.coalesce(kind(node) == "STRING", F.lit(False))


def is_object(node: Column) -> Column:
    return F.coalesce(kind(node).startswith("OBJECT"), F.lit(False))


def as_type(node: Column, data_type: str) -> Column:
    """Lenient scalar conversion; NULL when the value does not convert."""
    return F.try_variant_get(node, "$", data_type)


def as_text(node: Column) -> Column:
    return as_type(node, "string")


def scalar_text(node: Column) -> Column:
    """Text of a scalar; objects and arrays give NULL.

    The type is looked up only for text that starts like a container.
    """
    text = as_text(node)
    return F.when(~(text.startswith("{") | text.startswith("[")) | is_text(node), text)


def truthy(node: Column) -> Column:
    """Present and neither null, empty text, zero, false nor an empty container."""
    text = as_text(node)
    empty = (text == "") | (text.isin(*_FALSY_TEXT) & ~is_text(node))
    return F.coalesce(has_value(node) & ~empty, F.lit(False))
