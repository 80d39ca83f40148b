"""Message codecs as column expressions (no Python per row).

* edge message   ``"src weight dst src_lon src_lat dst_lon dst_lat"`` (space separated, lon before lat)
* query message  ``"s1 s2 …\\ne1 e2 …"``
* result line    ``"total n0 w0 n1 w1 … nk"``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE_FIELDS = ["src", "weight", "dst", "src_lon", "src_lat", "dst_lon", "dst_lat"]
_EDGE_TYPES = ["bigint", "bigint", "bigint", "double", "double", "double", "double"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _once(value: Column, body) -> Column:
    """``body(v)`` with ``v = value`` worked out once per row.

    A column used n times in an expression is worked out n times inside a lambda or a filter (neither shares common parts), so a
    split text would be split again for each of its tokens."""
    return F.element_at(F.transform(F.array(value), body), 1)


# ---------------------------------------------------------------- edge messages

def format_edge(src="src", weight="weight", dst="dst", src_lon="src_lon", src_lat="src_lat",
                dst_lon="dst_lon", dst_lat="dst_lat") -> Column:
    """The edge message text."""
    parts = [_c(x).cast("string") for x in (src, weight, dst, src_lon, src_lat, dst_lon, dst_lat)]
    return F.concat_ws(" ", *parts)


def edge_message_rows(df: DataFrame, keep: tuple[str, ...] = (), **cols) -> DataFrame:
    """K4: ``(key, value)`` rows for a message sink. The key is the edge (``src-dst``), so all changes of one edge go to one
    partition of a topic, in their order."""
    key = F.concat_ws("-", _c(cols.get("src", "src")).cast("string"), _c(cols.get("dst", "dst")).cast("string"))
    return df.select(*keep, key.alias("key"), format_edge(**cols).alias("value"))


def parse_edge(value: Column | str) -> Column:
    """Struct of typed fields plus ``valid``; a message with a missing or non-numeric field, or a
    negative weight, is invalid (and ``valid`` never null)."""
    def typed(toks):
        fields = [F.try_element_at(toks, F.lit(i + 1)).try_cast(t).alias(n) for i, (n, t) in enumerate(zip(EDGE_FIELDS, _EDGE_TYPES))]
        return F.struct(*fields, F.size(toks).alias("n"))

    def checked(e):
        ok = e["n"] == 7
        for n in EDGE_FIELDS:
            ok = ok & e[n].isNotNull()
        ok = F.coalesce(ok & (e["weight"] >= 0), F.lit(False))
        return F.struct(F.struct(*[e[n].alias(n) for n in EDGE_FIELDS]).alias("edge"), ok.alias("valid"))

    return _once(_once(F.split(F.trim(_c(value)), r"\s+"), typed), checked)


def parse_edges(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """P1 on a message table: ``keep`` columns, the seven typed fields and ``valid``."""
    p = parse_edge(value)
    return df.select(*keep, p["edge"].alias("e"), p["valid"].alias("valid")).select(
        *keep, *[F.col(f"e.{n}").alias(n) for n in EDGE_FIELDS], "valid")


# ---------------------------------------------------------------- query messages

def format_query(starts: Column | str = "starts", ends: Column | str = "ends") -> Column:
    """K5: ``"s1 s2\\ne1 e2"``."""
    return F.concat(F.array_join(F.transform(_c(starts), lambda x: x.cast("string")), " "), F.lit("\n"),
                    F.array_join(F.transform(_c(ends), lambda x: x.cast("string")), " "))


def parse_query(value: Column | str, id_type: str = "bigint") -> Column:
    """Struct ``(starts, ends)`` of distinct ids; empty tokens are ignored."""
    lines = F.split(_c(value), "\n")

    def ids(line):
        toks = F.filter(F.split(F.trim(line), r"\s+"), lambda t: t != "")
        return F.array_distinct(F.transform(toks, lambda t: t.try_cast(id_type)))

    return F.struct(ids(F.try_element_at(lines, F.lit(1))).alias("starts"),
                    ids(F.coalesce(F.try_element_at(lines, F.lit(2)), F.lit(""))).alias("ends"))


# ---------------------------------------------------------------- result lines

def line_tokens(line: Column | str) -> Column:
    return F.split(F.trim(_c(line)), " ")


def line_total(line: Column | str) -> Column:
    return F.element_at(line_tokens(line), 1).cast("bigint")


def decode_hops(line: Column | str) -> Column:
    """``array<struct<src, weight, dst>>`` of a result line; empty for a zero-hop line."""
    def hops(toks):
        n = ((F.size(toks) - 2) / 2).cast("int")
        return F.when(n > 0, F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                F.element_at(toks, i * 2 + 2).cast("bigint").alias("src"),
                F.element_at(toks, i * 2 + 3).cast("bigint").alias("weight"),
                F.element_at(toks, i * 2 + 4).cast("bigint").alias("dst"),
            ))).otherwise(F.array().cast("array<struct<src:bigint,weight:bigint,dst:bigint>>"))

    return _once(line_tokens(line), hops)


def is_zero_hop(line: Column | str) -> Column:
    """Whether ``decode_hops`` gives no hop, from the number of tokens alone."""
    return F.coalesce(F.size(line_tokens(line)), F.lit(0)) < 4


def decode_nodes(line: Column | str) -> Column:
    """Node ids of a result line (the even slots after the total)."""
    return _once(line_tokens(line), lambda toks: F.transform(
        F.sequence(F.lit(0), ((F.size(toks) - 2) / 2).cast("int")), lambda i: F.element_at(toks, i * 2 + 2).cast("bigint")))


def encode_line(total: Column | str, first: Column | str, hops: Column | str) -> Column:
    """``"total n0 w0 n1 … nk"`` from the total, the first node and the hops (in order)."""
    tail = F.array_join(F.flatten(F.transform(
        _c(hops), lambda h: F.array(h["weight"].cast("string"), h["dst"].cast("string")))), " ")
    head = F.concat_ws(" ", _c(total).cast("string"), _c(first).cast("string"))
    return F.when(F.size(_c(hops)) > 0, F.concat_ws(" ", head, tail)).otherwise(head)
