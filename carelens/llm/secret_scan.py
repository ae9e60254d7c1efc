"""Secret scan with multipart credential linking (native functions only).

Three *base* kinds are always reported: ``assign`` (a keyword assigned a
value), ``access`` (an access-key identifier) and ``hex`` (a long lower-case
hexadecimal run).  Three *weak* kinds are too common in ordinary text to be
reported alone: ``ident`` (an account name or client id being assigned),
``blob`` (a long mixed base64-like run) and ``endpoint`` (a URL with a host).
Each kind plays a role: identifier (access, ident), secret (assign, hex, blob)
or endpoint.  A weak candidate is reported only when complementary parts occur
in its scope, i.e. start within ``SCOPE`` code points of its own start: an
identifier or an endpoint complements a secret, a secret complements both.
The complement must be a base find, or all three roles must be present.

The linking is an interval join: spans and scopes are cut into cells of
``SCOPE`` code points, the spans of a cell are folded to their first and last
start per role, and each weak candidate meets the folds of its own and the two
neighbouring cells.  That decides every case exactly (a span in the same cell
is in scope, of a neighbouring cell the nearest span decides) without ever
forming pairs of spans, so a text with very many finds stays linear.

Positions come from splitting the text at the matches: match i starts after
the first i pieces and matches; all lengths are in code points.

Defined results: NULL text is empty; repeated rows are scanned one by one
(rows are told apart by an id of their own); an empty table gives an empty
result; other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import let, materialize, running, text_or_empty

SCOPE = 300


@dataclass(frozen=True)
class Kind:
    name: str
    role: str
    base: bool
    pattern: str  # Java regular expression, also valid for RE2
    group: int = 0
    shortest: int = 0  # characters the group needs


_KEYWORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_IDENT = "([Uu][Ss][Ee][Rr]_?[Nn][Aa][Mm][Ee]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]_?[Ii][Dd]|[Ll][Oo][Gg][Ii][Nn])"
_ASSIGNED = "[\"']?\\x20*[:=]\\x20*[\"']?"

# In the order spans of equal start are listed.
KINDS = (
    Kind("assign", "secret", True, f"{_KEYWORD}{_ASSIGNED}([A-Za-z0-9+/_.=-]+)", 2, 6),
    # Runs are maximal, so asking for the length in the pattern finds the
    # same spans as dropping short matches afterwards.
    Kind("access", "identifier", True, "AKIA[A-Z0-9]{16,}"),
    Kind("hex", "secret", True, "[0-9a-f]{24,}"),
    Kind("ident", "identifier", False, f"{_IDENT}{_ASSIGNED}([A-Za-z0-9@_.-]+)", 2, 3),
    Kind("blob", "secret", False, "[A-Za-z0-9+/]{40,}"),
    Kind("endpoint", "endpoint", False, "https?://[A-Za-z0-9.-]+"),
)
ROLES = ("identifier", "secret", "endpoint")
COMPLEMENTS = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("secret",)}
SPAN = "struct<start:long,kind:int,stop:long>"


def _spans(text: Column, number: int, kind: Kind) -> Column:
    """Spans of one kind: array of (start, kind number, stop)."""
    pattern = F.lit(kind.pattern)
    pieces = F.transform(F.split(text, kind.pattern, -1), lambda x: F.char_length(x))
    found = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.char_length(x))
    if kind.group:
        values = F.transform(F.regexp_extract_all(text, pattern, F.lit(kind.group)), lambda x: F.char_length(x))
    else:
        values = found
    # Piece i precedes match i; the piece after the last match has no match.
    steps = F.zip_with(pieces, found, lambda gap, n: (gap + F.coalesce(n, F.lit(0))).cast("long"))

    def placed(before: Column) -> Column:
        rows = F.arrays_zip(before.alias("before"), pieces.alias("gap"), found.alias("len"), values.alias("value"))
        long_enough = F.filter(rows, lambda r: r["len"].isNotNull() & (r["value"] >= kind.shortest))
        return F.transform(long_enough, lambda r: F.struct(
            (r["before"] + r["gap"]).cast("long").alias("start"), F.lit(number).alias("kind"),
            (r["before"] + r["gap"] + r["len"]).cast("long").alias("stop"))).cast(f"array<{SPAN}>")

    starts = let(steps, lambda x: running(x, lambda a, b: a + b))
    return F.when(F.regexp_like(text, pattern), let(starts, placed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_spans(text: Column) -> Column:
    """Base and weak spans of a text, sorted by start, then kind."""
    return F.sort_array(F.concat(*[_spans(text, i, k) for i, k in enumerate(KINDS)]))


def link(spans: DataFrame, row: str = "row_id", found: str = "found") -> DataFrame:
    """(row, linked): the weak spans of each row that are reported."""
    base = F.array(*[F.lit(k.base) for k in KINDS])
    role = F.array(*[F.lit(k.role) for k in KINDS])
    # Only rows with a weak candidate and a second role can link anything.
    roles = F.array_distinct(F.transform(found, lambda s: role[s["kind"]]))
    weak_in = F.exists(found, lambda s: ~base[s["kind"]])
    one = (
        spans.where(weak_in & (F.size(roles) > 1))
        .select(row, F.explode(found).alias("s"))
        .select(row, "s", F.floor(F.col("s.start") / SCOPE).alias("cell"),
                role[F.col("s.kind")].alias("role"), base[F.col("s.kind")].alias("base")))
    is_role = {r: F.col("role") == r for r in ROLES}
    # First and last start per role, of base spans and of all spans.
    folds = one.groupBy(row, "cell").agg(*[
        agg(F.when(is_role[r] & strong, F.col("s.start"))).alias(f"{side}_{r}_{which}")
        for r in ROLES for which, strong in (("base", F.col("base")), ("any", F.lit(True)))
        for side, agg in (("first", F.min), ("last", F.max))])
    probes = (
        one.where(~F.col("base"))
        .select(row, "s", "role", F.col("cell").alias("own"),
                F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell")))
    j = probes.join(folds, [row, "cell"])
    at = F.col("s.start")

    def near(r: str, which: str) -> Column:
        first, last = F.col(f"first_{r}_{which}"), F.col(f"last_{r}_{which}")
        return F.coalesce(
            F.when(F.col("cell") == F.col("own"), first.isNotNull())
            .when(F.col("cell") < F.col("own"), at - last <= SCOPE)
            .otherwise(first - at <= SCOPE), F.lit(False))

    per = j.groupBy(row, "s", "role").agg(*[
        F.max(near(r, which)).alias(f"{which}_{r}") for r in ROLES for which in ("base", "any")])
    strong = F.lit(False)
    for r, needs in COMPLEMENTS.items():
        has = F.lit(False)
        for n in needs:
            has = has | F.col(f"base_{n}")
        strong = strong | ((F.col("role") == r) & has)
    all_three = F.col("any_identifier") & F.col("any_secret") & F.col("any_endpoint")
    return per.where(strong | all_three).groupBy(row).agg(F.collect_list("s").alias("linked"))


def secret_scan(spark: SparkSession, docs: DataFrame, text: str = "text",
                carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, ``base`` and ``spans`` (arrays of start, kind, stop;
    kind is the index in ``KINDS``): base finds, and those plus the linked
    weak finds."""
    found = docs.select(*carry, let(text_or_empty(text), find_spans).alias("found"))
    # Written once: the row id then stays the same for every reader.
    scanned = materialize(spark, found.withColumn("row_id", F.monotonically_increasing_id()), "secret-spans")
    linked = link(scanned)
    is_base = F.array(*[F.lit(k.base) for k in KINDS])
    base = F.filter("found", lambda s: is_base[s["kind"]])
    # Most rows have no linked span; they need no look-up.
    j = scanned.join(linked, "row_id", "left")
    none = F.array().cast(f"array<{SPAN}>")
    return j.select(
        *carry, base.alias("base"),
        F.sort_array(F.concat(base, F.coalesce(F.col("linked"), none))).alias("spans"))


def span_text(spans: str | Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """The text with every span (overlapping ones merged) replaced."""

    def cover(sp: Column) -> Column:
        stops = F.transform(sp, lambda x: x["stop"])

        def build(done: Column) -> Column:
            rows = F.arrays_zip(sp.alias("s"), done.alias("done"))
            apart = F.filter(rows, lambda r: r["s"]["start"] >= r["done"])
            parts = F.transform(apart, lambda r: F.concat(
                F.substring(text, (r["done"] + 1).cast("int"), (r["s"]["start"] - r["done"]).cast("int")), F.lit(mask)))
            return F.concat(F.array_join(parts, ""), F.substring(text, (F.array_max(stops) + 1).cast("int"), F.lit(2**31 - 1)))

        return let(running(stops, F.greatest), build)

    return F.when(F.size(spans) > 0, let(spans, cover)).otherwise(text)
