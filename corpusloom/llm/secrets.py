"""Secret scans: base patterns, then multipart credential linking, with DataFrame functions only.

Positions come from splitting a text at a pattern: pieces and matches alternate, so running lengths give offsets in code
points. Base spans (assign, access, hex) are always reported. Weak candidates (weak_id: account or key identifiers too weak
alone, weak_secret: short assigned values and long mixed strings, endpoint: urls) are reported only when complementary parts
co-occur in their scope, at most SCOPE code points from the end of one to the start of the other: an identifier needs a
secret, a secret needs an identifier or an endpoint, an endpoint needs both. Base spans count as parts. The interval join is an equi-join on row and scope bin, each
part standing in the bins that it covers and both neighbouring ones, as a semi-join: it never makes pairs.

Defined results: a null text counts as empty and has no span; repeated rows are scanned one by one; extra columns may clash
with no working column, since each input row is packed in one struct. Work in a row grows with its text's length and with its
number of matches to the power of 1.5 at most (short array appends).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
WEAK_ID = r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|user_?id|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{4,})"""
WEAK_STRING = r"[A-Za-z0-9+/]{32,}"
ENDPOINT = r"""(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""

KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
BASE = 3
ASSIGN_CHARS, ACCESS_CHARS, WEAK_ASSIGN_CHARS = 12, 18, 6
SCOPE = 200
MASK = "[SECRET]"

_SPAN = "struct<s:int,k:int,e:int>"
_NONE = f"cast(array() as array<{_SPAN}>)"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once and not for each element of a lambda that it stands in."""
    return F.get(F.transform(F.array(value), then), 0)


def _scan(items: Column, state: Column, advance, emit, kind: str) -> Column:
    """emit(state, x) (arrays of kind) of each item one after another, where advance(state, x) makes the next state.

    Items go by runs of about the square root of their number: appending copies what is there, so one fold over all m would
    copy m * m / 2 elements, this one m to the power of 1.5.
    """
    none = f"cast(array() as array<{kind}>)"

    def run(items: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(items))).cast("int")

        def inner(acc: Column, x: Column) -> Column:
            return F.struct(advance(acc["state"], x).alias("state"), F.concat(acc["out"], emit(acc["state"], x)).alias("out"))

        def outer(acc: Column, at: Column) -> Column:
            start = F.struct(acc["state"].alias("state"), F.expr(none).alias("out"))
            done = F.aggregate(F.slice(items, at * size + 1, size), start, inner)
            return _let(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

        zero = F.struct(state.alias("state"), F.expr(f"cast(array() as array<array<{kind}>>)").alias("out"))
        runs = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int"))
        return F.when(F.size(items) > 0, F.flatten(F.aggregate(runs, zero, outer)["out"])).otherwise(F.expr(none))

    return _let(items, run)


def _spans(text: Column, pattern: str, kind: Column | int, keep=None, group: int = 0) -> Column:
    """Spans (start, kind, end) of the leftmost non-overlapping matches; keep and kind may depend on the match or its group."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("own"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
        F.split(text, pattern, -1).alias("gaps"),
    )

    def matches(f: Column) -> Column:
        one = lambda x, i: F.struct(F.length(F.get(f["gaps"], i)).alias("gap"), F.length(x).alias("size"), F.get(f["part"], i).alias("value"))
        return F.transform(f["own"], one)

    def emit(at: Column, x: Column) -> Column:
        start, value = at + x["gap"], x["value"]
        k = kind(value) if callable(kind) else F.lit(kind)
        span = F.array(F.struct(start.alias("s"), k.alias("k"), (start + x["size"]).alias("e")))
        return span if keep is None else F.when(keep(value), span).otherwise(F.expr(_NONE))

    walked = _scan(_let(found, matches), F.lit(0), lambda at, x: at + x["gap"] + x["size"], emit, _SPAN)
    return F.when(text.rlike(pattern), walked).otherwise(F.expr(_NONE))


def candidate_spans(text: Column) -> Column:
    """Base spans and weak candidates of a text, as an array of (s, k, e) in no defined order; k indexes KINDS."""
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Z]") & v.rlike("[a-z]")
    return F.concat(
        _spans(
            text,
            ASSIGN,
            lambda v: F.when(F.length(v) >= ASSIGN_CHARS, F.lit(0)).otherwise(F.lit(4)),
            lambda v: F.length(v) >= WEAK_ASSIGN_CHARS,
            group=2,
        ),
        _spans(
            text,
            ACCESS,
            lambda v: F.when(F.length(v) >= ACCESS_CHARS, F.lit(1)).otherwise(F.lit(3)),
            lambda v: F.length(v) >= 8,
        ),
        _spans(text, HEX, 2),
        _spans(text, WEAK_ID, 3),
        _spans(text, WEAK_STRING, 4, mixed),
        _spans(text, ENDPOINT, 5),
    )


def _without_covered(spans: Column) -> Column:
    """Base spans, and weak ones that overlap no base span: none before them ends after their start, none after them starts
    before their end. In the order of spans turned round."""
    base = lambda x: x["k"] < BASE
    marked = _scan(
        F.array_sort(spans),
        F.lit(0),
        lambda end, x: F.when(base(x), F.greatest(end, x["e"])).otherwise(end),
        lambda end, x: F.when(base(x) | (end <= x["s"]), F.array(x)).otherwise(F.expr(_NONE)),
        _SPAN,
    )
    kept = _scan(
        F.reverse(marked),
        F.lit(2147483647),
        lambda start, x: F.when(base(x), x["s"]).otherwise(start),
        lambda start, x: F.when(base(x) | (start >= x["e"]), F.array(x)).otherwise(F.expr(_NONE)),
        _SPAN,
    )
    return F.when(F.exists(spans, lambda x: x["k"] >= BASE), kept).otherwise(spans)


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """row, spans: the weak spans with complementary parts in scope, of the rows that have any."""
    parts = found.where(F.exists("spans", lambda x: x["k"] >= BASE)).select("row", F.explode("spans").alias("x"))
    parts = materialize(parts.select("row", "x.s", "x.k", "x.e"), "secret-parts")
    covered = F.explode(F.sequence(F.expr(f"s div {scope}"), F.expr(f"e div {scope}"))).alias("bin")
    weak = parts.where(f"k >= {BASE}").select("row", "s", "k", "e", covered)

    def near(kinds: tuple[int, ...], name: str) -> DataFrame:
        around = F.explode(F.sequence(F.expr(f"s div {scope} - 1"), F.expr(f"e div {scope} + 1"))).alias("bin")
        return parts.where(F.col("k").isin(*kinds)).select(*(F.col(c).alias(f"{name}_{c}") for c in ("row", "s", "e")), around)

    def with_near(rows: DataFrame, other: DataFrame, name: str) -> DataFrame:
        other = other.withColumnRenamed("bin", f"{name}_bin")
        on = (F.col("row") == F.col(f"{name}_row")) & (F.col("bin") == F.col(f"{name}_bin"))
        gap = F.greatest("s", f"{name}_s") - F.least("e", f"{name}_e")
        return rows.join(other, on & (gap <= scope), "left_semi")

    ids, keys, ends = near((1, 3), "i"), near((0, 2, 4), "k"), near((5,), "p")
    partner = ids.toDF("p_row", "p_s", "p_e", "bin").unionByName(ends)
    # a long endpoint may meet its identifier in one bin and its secret in another
    endpoints = with_near(weak.where("k = 5"), ids, "i").select("row", "s", "k", "e").distinct()
    endpoints = endpoints.select("row", "s", "k", "e", covered)
    kept = (
        with_near(weak.where("k = 3"), keys, "k")
        .unionByName(with_near(weak.where("k = 4"), partner, "p"))
        .unionByName(with_near(endpoints, keys, "k"))
    )
    kept = kept.select("row", "s", "k", "e").distinct()
    return kept.groupBy("row").agg(F.collect_list(F.struct("s", "k", "e")).alias("weak"))


def scan_secrets(docs: DataFrame, text_col: str = "text", scope: int = SCOPE, keep: list[str] | None = None) -> DataFrame:
    """The columns in keep (all of docs by default) in a struct `doc`, and `spans`: sorted array of (s, k, e)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep or docs.columns)).alias("doc"), text.alias("text"))
    found = packed.select("doc", candidate_spans(F.col("text")).alias("spans")).select("doc", _without_covered(F.col("spans")).alias("spans"))
    found = materialize(found.withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    weak = F.exists("spans", lambda x: x["k"] >= BASE)
    base = F.filter("spans", lambda x: x["k"] < BASE)
    linked = found.where(weak).join(_linked(found.select("row", "spans"), scope), "row", "left")
    linked = linked.select("doc", F.concat(base, F.coalesce("weak", F.expr(_NONE))).alias("spans"))
    rows = found.where(~weak).select("doc", "spans").unionByName(linked)
    return rows.select("doc", F.array_sort("spans").alias("spans"))


def span_text(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def secret_digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, sha-256 of the base spans and all spans as text."""
    base = F.filter("spans", lambda x: x["k"] < BASE)
    count = lambda i: F.size(F.filter("spans", lambda x: x["k"] == i)).cast("bigint")
    return scanned.select(
        F.col(f"doc.`{id_col}`").alias(id_col),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def mask_spans(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with every span of a sorted array (overlapping ones as one) replaced by mask."""

    def masked(t: Column) -> Column:
        before = lambda at, x: F.concat(F.substring(t, at + 1, x["s"] - at), F.lit(mask))
        none = F.expr("cast(array() as array<string>)")
        ahead = lambda at, x: F.when(x["s"] >= at, F.array(before(at, x))).otherwise(none)
        pieces = _scan(spans, F.lit(0), lambda at, x: F.greatest(at, x["e"]), ahead, "string")
        last = F.array_max(F.transform(spans, lambda x: x["e"]))
        return F.concat(F.array_join(pieces, ""), F.substring(t, last + 1, F.length(t)))

    return F.when(F.size(spans) > 0, _let(text, masked)).otherwise(text)
