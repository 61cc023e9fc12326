"""Secret scans: patterns find the parts of credentials, an interval join links the weak ones.

An access identifier, a secret and an endpoint are the parts of a credential. Parts of
a fixed form (``BASE``) are reported as found. Weak parts (login names, random-looking
words, addresses) are common in clean text and are reported only where at most ``reach``
code points lie between them and complementary parts, and where no base part covers them.

Only built-in functions are used. The places of all matches of a pattern come from the
lengths of the pieces between them, summed up by a window per text, so no match is
searched twice. The interval join is a pair of windows over the parts of one text: the
furthest end of each role behind a part and the nearest start ahead, running values in
either direction, never pair by pair. Only part rows are shuffled, not texts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelfmark.llm.quality_rules import let

from shelfmark.llm.common import free_name, without

REACH = 200


class Kind(NamedTuple):
    """A pattern whose matches are kept if ``group`` has ``least`` characters; ``role``: id, secret or endpoint."""

    name: str
    pattern: str
    group: int
    least: int
    role: str


# The patterns of the base kinds, in their listed order.
BASE = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, "secret"),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18, "id"),
    Kind("hex", r"[0-9a-f]+", 0, 16, "secret"),
)

_RANDOM = r"[A-Za-z0-9+/_-]"
WEAK = (
    Kind("login", r"""(?i)(?<![A-Za-z0-9])(user_?name|user_?id|login|client_?id|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""",
         2, 3, "id"),
    Kind("blob", rf"(?<!{_RANDOM})(?={_RANDOM}*[a-z])(?={_RANDOM}*[A-Z])(?={_RANDOM}*[0-9]){_RANDOM}{{24,}}", 0, 24, "secret"),
    Kind("endpoint", r"https?://[A-Za-z0-9][A-Za-z0-9._:/-]*", 0, 10, "endpoint"),
)
KINDS = (*BASE, *WEAK)

# An equal pattern that skips short matches early, where that cannot change which matches are found: greedy runs of one class.
_SEARCHED = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}


def parts_of(text: Column) -> Column:
    """All matches of all kinds: kind number, place in its kind, lengths of the gap before and of the match, whether it is kept."""
    def found(number: int, kind: Kind) -> Column:
        pattern = F.lit(_SEARCHED.get(kind.name, kind.pattern))
        hits = F.regexp_extract_all(text, pattern, F.lit(0))
        judged = F.regexp_extract_all(text, pattern, F.lit(kind.group))

        def rows(h: Column, gaps: Column, groups: Column) -> Column:
            return F.transform(h, lambda x, i: F.struct(
                F.lit(number).alias("kind"), i.alias("place"), F.length(F.get(gaps, i)).cast("long").alias("gap"),
                F.length(x).cast("long").alias("size"), (F.length(F.get(groups, i)) >= kind.least).alias("ok")))

        none = F.array().cast("array<struct<kind:int,place:int,gap:bigint,size:bigint,ok:boolean>>")
        return let(hits, lambda h: F.when(F.size(h) > 0, let(
            F.split(text, kind.pattern if kind.name not in _SEARCHED else _SEARCHED[kind.name], -1),
            lambda gaps: rows(h, gaps, h) if kind.group == 0 else let(judged, lambda groups: rows(h, gaps, groups)))).otherwise(none))

    return F.concat(*[found(i, kind) for i, kind in enumerate(KINDS)])


def located(df: DataFrame, row: str, carried: list[str]) -> DataFrame:
    """One line per match with ``start`` and ``end`` (code points, end exclusive), all in the task of its text; texts without match keep one line."""
    lines = df.select(row, *carried, F.explode_outer("_parts").alias("_part")).select(row, *carried, "_part.*").repartition(row)
    run = Window.partitionBy(row, "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(run)
    return lines.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))


def linked(lines: DataFrame, row: str, reach: int) -> DataFrame:
    """Sets ``reported``: base parts always, weak parts that no base part covers and whose complements lie in scope."""
    roles = {role: [i for i, k in enumerate(KINDS) if k.role == role] for role in ("id", "secret", "endpoint")}
    upto = Window.partitionBy(row).orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.partitionBy(row).orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ok, base = F.col("ok"), F.col("kind") < len(BASE)

    def beside(own: list[int]) -> Column:
        one = ok & F.col("kind").isin(own)
        behind = F.max(F.when(one, F.col("end"))).over(upto) >= F.col("start") - reach
        ahead = F.min(F.when(one, F.col("start"))).over(onward) <= F.col("end") + reach
        return F.coalesce(behind, F.lit(False)) | F.coalesce(ahead, F.lit(False))

    near = {role: beside(own) for role, own in roles.items()}
    inside = F.coalesce(F.max(F.when(ok & base, F.col("end"))).over(upto) >= F.col("end"), F.lit(False))
    seen = lines.select("*", *[v.alias(f"_near_{k}") for k, v in near.items()], inside.alias("_inside"))
    weak = {
        "login": F.col("_near_secret"),
        "blob": (F.col("_near_id") | F.col("_near_endpoint")),
        "endpoint": F.col("_near_id") & F.col("_near_secret"),
    }
    rule = base
    for number, kind in enumerate(KINDS[len(BASE):], len(BASE)):
        rule = rule | ((F.col("kind") == number) & weak[kind.name] & ~F.col("_inside"))
    return seen.withColumn("reported", F.coalesce(ok & rule, F.lit(False)))


def scan(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, reach: int = REACH) -> DataFrame:
    """The kept columns (scalars, not the text) of every row and its credential spans.

    Result columns: ``n_assign``, ``n_access``, ``n_hex`` and ``spans``, an array of
    (start, kind, end) by start, then kind; kinds by number, see ``KINDS``. A null or
    empty text has no spans. Repeated rows stay apart (rows are numbered for the job),
    also when their ids are equal or null. The numbers are those of the rows in their files: give it a
    table that is read, or one cut by ``cut_lineage``, not the result of a shuffle.
    """
    carried = without(keep if keep is not None else [c for c in df.columns if c != text_col], ("n_assign", "n_access", "n_hex", "spans"))
    renamed = [f"_in{i}" for i in range(len(carried))]
    source = df.select(F.monotonically_increasing_id().alias("_row"), parts_of(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_parts"),
                       *[F.col(f"`{c}`").alias(r) for c, r in zip(carried, renamed)])
    lines = linked(located(source, "_row", renamed), "_row", reach)
    counts = [F.count_if(F.col("reported") & (F.col("kind") == i)).alias(f"n_{k.name}") for i, k in enumerate(BASE)]
    span = F.when(F.col("reported"), F.struct("start", "kind", "end"))
    grouped = lines.groupBy("_row").agg(*[F.first(r).alias(r) for r in renamed], *counts,
                                        F.sort_array(F.collect_list(span)).alias("spans"))
    return grouped.select(*[F.col(r).alias(c) for r, c in zip(renamed, carried)], "n_assign", "n_access", "n_hex", "spans")


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < len(BASE))


def mask(text: Column, spans: Column, mark: str = "[MASKED]") -> Column:
    """The text with each maximal run of reported characters replaced by one mark."""
    kind = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    empty = F.array().cast(kind)
    # Spans come by start: each either widens the last run or opens the next.
    merged = F.aggregate(spans, empty, lambda runs, s: F.when(
        (F.size(runs) > 0) & (F.element_at(runs, -1)["end"] >= s["start"]),
        F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(
            F.element_at(runs, -1)["start"].alias("start"),
            F.greatest(F.element_at(runs, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(runs, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))).cast(kind))

    def pieces(runs: Column) -> Column:
        def piece(i: Column) -> Column:
            begin = F.when(i == 0, F.lit(0)).otherwise(F.get(runs, i - 1)["end"])
            stop = F.when(i == F.size(runs), F.length(text).cast("long")).otherwise(F.get(runs, i)["start"])
            return F.substring(text, (begin + 1).cast("int"), (stop - begin).cast("int"))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(runs)), piece), mark)

    return F.when(F.size(spans) > 0, let(merged, pieces)).otherwise(text)


def masked(df: DataFrame, text_col: str = "text", reach: int = REACH) -> DataFrame:
    """All rows and columns, with reported credentials masked in the text; null stays null.

    Spans depend on the text alone, so they are joined back by the text's digest:
    ids may be null or repeated. Only texts with spans take part in the join's right side.
    """
    columns = df.columns
    key, found = free_name(columns, "_key"), free_name(columns, "_spans")
    # Null texts have nothing to mask; without a digest they would all meet in one task.
    empty = df.filter(F.col(f"`{text_col}`").isNull())
    keyed = df.filter(F.col(f"`{text_col}`").isNotNull()).select("*", F.md5(F.col(f"`{text_col}`").cast("binary")).alias(key))
    spans = scan(keyed, text_col, keep=[key], reach=reach).filter(F.size("spans") > 0).groupBy(key).agg(
        F.any_value("spans").alias(found))
    text = F.when(F.col(found).isNotNull(), mask(F.col(f"`{text_col}`"), F.col(found))).otherwise(F.col(f"`{text_col}`"))
    joined = keyed.join(spans, key, "left")
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in columns]).unionByName(empty)
