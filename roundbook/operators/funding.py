"""Funding-round operators: listings, investor/round texts, totals, quarters.

Inputs use the domain column names of :mod:`roundbook.schemas`. All joins are
key equi-joins; all per-company/per-round aggregates are either partial
aggregations (sum/count/min) or the skew-safe ordered operators of
:mod:`roundbook.operators.ordering`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import quarters as Q
from ..functions import text as TX
from .match import quote  # noqa: F401  (column names as SQL identifiers)
from .ordering import group_positions, ordered_concat


def round_order() -> list:
    """Listing order of rounds (O1): newest announcement first, then newest
    close; ``round_uuid`` makes the order total."""
    return [
        F.col("announced_on").desc_nulls_last(),
        F.col("closed_on").desc_nulls_last(),
        F.col("round_uuid").asc(),
    ]


def listing_key() -> "F.Column":
    """A struct whose ascending order is the listing order :func:`round_order`."""
    epoch = F.lit("1970-01-01").cast("date")
    return F.struct(
        F.col("announced_on").isNull().alias("a_null"),
        (-F.datediff("announced_on", epoch)).alias("a"),
        F.col("closed_on").isNull().alias("c_null"),
        (-F.datediff("closed_on", epoch)).alias("c"),
        F.col("round_uuid").alias("u"),
    )


def investor_key() -> "F.Column":
    """A struct whose ascending order is the investor listing order (O2):
    leads first (true, false, NULL), then name with NULL last; amount breaks
    ties. Rows with equal keys have equal entry text, so ties are harmless."""
    lead = F.when(F.col("is_lead"), 0).when(~F.col("is_lead"), 1).otherwise(2)
    return F.struct(
        lead.alias("lead"),
        F.col("investor_name").isNull().alias("n_null"),
        F.col("investor_name").alias("name"),
        F.col("amount_usd").isNull().alias("a_null"),
        F.col("amount_usd").alias("amount"),
    )


def rounds_for(orgs: DataFrame, rounds: DataFrame, by: str = "uuid") -> DataFrame:
    """Rounds of the given organizations (J2), or matched by name.

    ``by="name"`` joins ``orgs.name`` to ``rounds.org_name``; same-named
    companies then share their rounds, as in the reference.
    ``by="uuid_else_name"`` takes the rounds of each company's uuid, and of its
    name where it has no uuid.
    """
    if by == "uuid":
        keys = orgs.select("org_uuid").distinct()
        return rounds.join(keys, "org_uuid", "left_semi")
    if by == "name":
        keys = orgs.select(F.col("org_uuid").alias("matched_uuid"), F.col("name").alias("org_name"))
        return rounds.join(keys, "org_name")
    if by == "uuid_else_name":
        # a company without a uuid is looked up by its name; every company
        # once, and rounds of a repeated name once
        known = orgs.where(TX.nonblank("org_uuid")).select("org_uuid").distinct()
        named = orgs.where(~F.coalesce(TX.nonblank("org_uuid"), F.lit(False))).select(F.col("name").alias("org_name")).distinct()
        own = rounds.join(known.withColumn("__rb_u", F.lit(True)), "org_uuid", "left").join(named.withColumn("__rb_n", F.lit(True)), "org_name", "left")
        return own.where("__rb_u OR __rb_n").select(*rounds.columns)
    raise ValueError(f"by must be 'uuid', 'name' or 'uuid_else_name', not {by!r}")


def rounds_listing(rounds: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Rounds with ``pos``: 1-based place in the company's listing (O1)."""
    return group_positions(rounds, ["org_uuid"], round_order(), listing_key(), "pos", sizes=sizes)


def investor_text(investments: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """``(round_uuid, investors)``: ``Name (Lead) ($n), …`` per round."""
    inv = investments.select(
        "round_uuid", "is_lead", "investor_name", "amount_usd", TX.investor_entry().alias("entry")
    )
    return ordered_concat(inv, ["round_uuid"], investor_key(), "entry", ", ", "investors", sizes=sizes)


def round_texts(rounds: DataFrame, investments: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Rounds left-joined with their investor text, plus ``round_text``."""
    return rounds.join(investor_text(investments, sizes), "round_uuid", "left").withColumn("round_text", TX.round_entry())


def funding_text(rounds: DataFrame, investments: DataFrame, round_sizes: DataFrame | None = None, investment_sizes: DataFrame | None = None) -> DataFrame:
    """``(org_uuid, funding_info)``: round texts in listing order joined by `` | `` (A10).

    ``round_sizes``, ``investment_sizes``: frames with at least as many rows of each
    company and round, if these are cheaper to count.
    """
    rt = round_texts(rounds, investments, investment_sizes).select(
        "org_uuid", "announced_on", "closed_on", "round_uuid", "round_text"
    )
    return ordered_concat(rt, ["org_uuid"], listing_key(), "round_text", " | ", "funding_info", sizes=rounds if round_sizes is None else round_sizes)


def total_funding(rounds: DataFrame) -> DataFrame:
    """``(org_uuid, total_funding)``: sum of non-zero amounts; NULL when 0."""
    amt = F.when(TX.nonzero("amount_usd"), F.col("amount_usd"))
    s = F.sum(amt)
    return rounds.groupBy("org_uuid").agg(F.when(s != 0, s).alias("total_funding"))


def funding_summary(rounds: DataFrame) -> DataFrame:
    """Per company: rounds, rounds with an amount, total and its display text."""
    amt = F.when(TX.nonzero("amount_usd"), F.col("amount_usd"))
    s = F.sum(amt)
    return rounds.groupBy("org_uuid").agg(
        F.count(F.lit(1)).alias("n_rounds"),
        F.count(amt).alias("n_rounds_with_amount"),
        F.when(s != 0, s).cast("double").alias("total_funding"),
        F.when(s != 0, TX.format_currency(s)).alias("total_funding_text"),
    )


def rounds_by_type(rounds: DataFrame) -> DataFrame:
    """Per company and non-blank type: count and display rank.

    Ranked by count descending; equal counts keep the order in which the
    type first appears in the company's listing, like a stable sort. The
    first appearance is ``min`` of the listing key — a partial aggregation,
    no per-company window over rounds.
    """
    from pyspark.sql import Window

    typed = rounds.where(TX.nonblank("investment_type"))
    counts = typed.groupBy("org_uuid", "investment_type").agg(
        F.count(F.lit(1)).alias("n_rounds"), F.min(listing_key()).alias("first_key")
    )
    # one row per (company, type): the window sorts a company's types only
    w = Window.partitionBy("org_uuid").orderBy(F.col("n_rounds").desc(), F.col("first_key").asc())
    return counts.withColumn("type_rank", F.row_number().over(w)).drop("first_key")


def quarterly_funding(rounds: DataFrame) -> DataFrame:
    """``(org_uuid, quarter, amount)``: non-zero amounts summed by the quarter of
    ``closed_on`` else ``announced_on``; rounds with neither are skipped (A2)."""
    d = Q.effective_date("closed_on", "announced_on")
    return (
        rounds.where(TX.nonzero("amount_usd") & d.isNotNull())
        .groupBy("org_uuid", Q.quarter_label(d).alias("quarter"))
        .agg(F.sum("amount_usd").alias("amount"))
    )


def quarter_sums(rounds: DataFrame) -> DataFrame:
    """``(org_uuid, quarter, amount)`` over all non-zero amounts; rounds without
    any date fall under a NULL quarter. One aggregation of the rounds from
    which both the total (A1) and the quarterly sums (A2) follow."""
    d = Q.effective_date("closed_on", "announced_on")
    return (
        rounds.where(TX.nonzero("amount_usd"))
        .groupBy("org_uuid", Q.quarter_label(d).alias("quarter"))
        .agg(F.sum("amount_usd").alias("amount"))
    )


def funding_by_quarter(rounds: DataFrame) -> DataFrame:
    """``(org_uuid, total_funding, amounts)``: the total (A1; NULL when 0) and a map from
    the index of each quarter with funding to its sum (A2).

    One aggregation by (company, quarter), then one by company: what travels from
    there on is an entry for each quarter that has funding, however long the axis.
    """
    d = Q.effective_date("closed_on", "announced_on")
    sums = rounds.where(TX.nonzero("amount_usd")).groupBy("org_uuid", Q.quarter_index(d).alias("i")).agg(F.sum("amount_usd").alias("amount"))
    s = F.sum("amount")
    entries = F.collect_list(F.when(F.col("i").isNotNull(), F.struct("i", F.col("amount").cast("double"))))
    return sums.groupBy("org_uuid").agg(F.when(s != 0, s).alias("total_funding"), F.map_from_entries(entries).alias("amounts"))


def on_axis(amounts: "F.Column", newest: int, oldest: int) -> "F.Column":
    """The amounts of all quarters from index ``newest`` down to ``oldest``, as a dense
    array; quarters off the axis are left out (A3)."""
    return F.transform(F.sequence(F.lit(newest), F.lit(oldest), F.lit(-1)), lambda i: F.element_at(amounts, i))


def quarter_series(orgs: DataFrame, as_of: dt.date) -> DataFrame:
    """``(org_uuid, quarter)``: each company's quarters from founding to ``as_of``.

    Hundreds of rows may come of one company, so the companies are dealt to many
    tasks first, as ends of their series: a table in one file would else be read and
    written out by one task. The number of tasks is the session's, since by their own
    few bytes the ends would be merged into one again. The labels are made past the
    explode, from the index.
    """
    first, last = Q.series_span(Q.founded_or_default("founded_on"), F.lit(as_of))
    ends = orgs.select("org_uuid", first.alias("__rb_first"), last.alias("__rb_last")).where("__rb_first <= __rb_last")
    ends = ends.repartition(int(orgs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    steps = ends.select("org_uuid", F.explode(F.sequence("__rb_first", "__rb_last")).alias("__rb_i"))
    return steps.select("org_uuid", Q.label_of_index("__rb_i").alias("quarter"))


def axis_span(orgs: DataFrame, as_of: dt.date) -> DataFrame:
    """One row ``(first_index, last_index)``: the union of all companies' series.

    Every series is a run of consecutive quarters ending in ``as_of``'s
    quarter or the one before, so the union is the single run from the
    smallest start to the largest end (A14).
    """
    first, last = Q.series_span(Q.founded_or_default("founded_on"), F.lit(as_of))
    return orgs.agg(F.min(first).alias("first_index"), F.max(last).alias("last_index"))


def quarter_axis(orgs: DataFrame, as_of: dt.date, oldest_year: int | str | None = None) -> list[str]:
    """Quarter column labels for a run, newest first.

    The list is bounded by 4 labels per calendar year spanned. An
    ``oldest_year`` keeps labels of that year or later; when it is not an
    integer, or would leave nothing, all labels are kept.
    """
    row = axis_span(orgs, as_of).first()
    if row is None or row["first_index"] is None:
        return []
    labels = Q.quarter_labels_between(int(row["first_index"]), int(row["last_index"]))
    if oldest_year is None or str(oldest_year).strip() == "":
        return labels
    try:
        y = int(str(oldest_year).strip())
    except ValueError:
        return labels
    kept = [q for q in labels if int(q[:4]) >= y]
    return kept or labels


def axis_frame(orgs: DataFrame, as_of: dt.date, oldest_year: int | None = None) -> DataFrame:
    """The axis as a DataFrame ``(quarter, year, q)`` without collecting anything."""
    span = axis_span(orgs, as_of).where(F.col("first_index").isNotNull())
    idx = span.select(F.explode(F.sequence("first_index", "last_index")).alias("i"))
    out = idx.select(
        Q.label_of_index("i").alias("quarter"), F.floor(F.col("i") / 4).cast("int").alias("year"),
        (F.pmod(F.col("i"), F.lit(4)) + 1).cast("int").alias("q"),
    )
    if oldest_year is not None:
        from pyspark.sql import Window

        # The axis has at most 4 rows per year spanned, so a global window is
        # bounded. Keep everything when the filter would leave nothing.
        newest = F.max("year").over(Window.partitionBy())
        out = (
            out.withColumn("_newest", newest)
            .where((F.col("_newest") < oldest_year) | (F.col("year") >= oldest_year))
            .drop("_newest")
        )
    return out


def quarterly_pivot(quarterly: DataFrame, axis: list[str]) -> DataFrame:
    """Wide ``(org_uuid, <quarter>…)`` with one DOUBLE column per axis label (A3).

    The explicit value list makes the pivot drop amounts in quarters outside
    the axis (they stay in the total), as in the reference; the cast sits in
    the pivot aggregate so no per-column projection is needed afterwards.
    """
    if not axis:
        return quarterly.select("org_uuid").distinct()
    return quarterly.groupBy("org_uuid").pivot("quarter", axis).agg(F.sum("amount").cast("double"))
