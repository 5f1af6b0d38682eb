"""Text builders of the enriched output (C10-C15), as Column expressions.

Money is formatted from DOUBLE with ``format_number``, which rounds the exact
binary value half-even like Python's ``:,.0f`` / ``:.2f``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonblank(c: Column | str) -> Column:
    """Python truthiness of a string: not NULL and not empty."""
    c = _col(c)
    return c.isNotNull() & (c != "")


def nonzero(c: Column | str) -> Column:
    """Python truthiness of a number: not NULL and not 0."""
    c = _col(c)
    return c.isNotNull() & (c != 0)


def thousands(x: Column | str) -> Column:
    """``f"{x:,.0f}"``."""
    return F.format_number(_col(x).cast("double"), 0)


def _fixed2(x: Column) -> Column:
    # format_number with a pattern: two decimals, no grouping
    return F.call_function("format_number", x, F.lit("0.00"))


def format_currency(x: Column | str) -> Column:
    """``$1.23B`` / ``$4.50M`` / ``$7.00K`` / ``$12.00``; ``N/A`` for NULL."""
    v = _col(x).cast("double")
    return (
        F.when(v.isNull(), F.lit("N/A"))
        .when(v >= 1e9, F.concat(F.lit("$"), _fixed2(v / 1e9), F.lit("B")))
        .when(v >= 1e6, F.concat(F.lit("$"), _fixed2(v / 1e6), F.lit("M")))
        .when(v >= 1e3, F.concat(F.lit("$"), _fixed2(v / 1e3), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), _fixed2(v)))
    )


def human_size(num_bytes: Column | str) -> Column:
    """``"512 B"``, ``"1.50 KB"`` ... ``"TB"``; ``"?"`` for NULL."""
    n = _col(num_bytes).cast("double")
    k = 1024.0

    def unit(div: float, name: str) -> Column:
        return F.concat(_fixed2(n / div), F.lit(" " + name))

    return (
        F.when(n.isNull(), F.lit("?"))
        .when(n < k, F.concat(n.cast("bigint").cast("string"), F.lit(" B")))
        .when(n < k**2, unit(k, "KB"))
        .when(n < k**3, unit(k**2, "MB"))
        .when(n < k**4, unit(k**3, "GB"))
        .otherwise(unit(k**4, "TB"))
    )


def _part(cond: Column, label: str, value: Column) -> Column:
    return F.when(cond, F.concat(F.lit(label), value))


def company_info(
    name="name",
    short_description="short_description",
    description="description",
    founded="founded",
    categories="categories",
    category_groups="category_groups",
    location="location",
    funding_stage="funding_stage",
    investor_stage="investor_stage",
    num_funding_rounds="num_funding_rounds",
    num_investors="num_investors",
) -> Column:
    """Company information text, parts joined by ``" | "`` (C11).

    ``founded`` is the founding date with the 1900-01-01 default already
    applied, so it is always present. Blank strings and 0 counts are dropped;
    ``concat_ws`` skips the NULL parts.
    """
    args = dict(locals())
    c = {k: _col(v) for k, v in args.items()}
    return F.concat_ws(
        " | ",
        _part(nonblank(c["name"]), "Name: ", c["name"]),
        _part(nonblank(c["short_description"]), "Description: ", c["short_description"]),
        _part(nonblank(c["description"]), "Full Description: ", c["description"]),
        _part(c["founded"].isNotNull(), "Founded: ", c["founded"].cast("string")),
        _part(nonblank(c["categories"]), "Categories: ", c["categories"]),
        _part(nonblank(c["category_groups"]), "Category Groups: ", c["category_groups"]),
        _part(nonblank(c["location"]), "Location: ", c["location"]),
        _part(nonblank(c["funding_stage"]), "Funding Stage: ", c["funding_stage"]),
        _part(nonblank(c["investor_stage"]), "Investor Stage: ", c["investor_stage"]),
        _part(nonzero(c["num_funding_rounds"]), "Number of Funding Rounds: ", c["num_funding_rounds"].cast("string")),
        _part(nonzero(c["num_investors"]), "Number of Investors: ", c["num_investors"].cast("string")),
    )


def investor_entry(name="investor_name", is_lead="is_lead", amount="amount_usd") -> Column:
    """One investor of a round: ``Name (Lead) ($1,000)`` (C14, part of A9)."""
    n, lead, amt = _col(name), _col(is_lead), _col(amount)
    who = F.when(nonblank(n), n).otherwise(F.lit("Unknown"))
    return F.concat(
        who,
        F.when(lead, F.lit(" (Lead)")).otherwise(F.lit("")),
        F.when(nonzero(amt), F.concat(F.lit(" ($"), thousands(amt), F.lit(")"))).otherwise(F.lit("")),
    )


def round_entry(
    round_name="round_name",
    announced_on="announced_on",
    closed_on="closed_on",
    amount="amount_usd",
    investment_type="investment_type",
    stage="stage",
    post_money="post_money_usd",
    pre_money="pre_money_usd",
    investors="investors",
    short_description="short_description",
) -> Column:
    """One round: ``[name] Announced: … Amount: $… Investors: … Details: …``.

    ``investors`` is the ready investor text (NULL when the round has none).
    A NULL round name prints as ``[None]``.
    """
    args = dict(locals())
    c = {k: _col(v) for k, v in args.items()}

    def opt(cond: Column, label: str, value: Column) -> Column:
        return F.when(cond, F.concat(F.lit(label), value)).otherwise(F.lit(""))

    return F.concat(
        F.lit("["),
        F.coalesce(c["round_name"], F.lit("None")),
        F.lit("]"),
        opt(c["announced_on"].isNotNull(), " Announced: ", c["announced_on"].cast("string")),
        opt(c["closed_on"].isNotNull(), " Closed: ", c["closed_on"].cast("string")),
        opt(nonzero(c["amount"]), " Amount: $", thousands(c["amount"])),
        opt(nonblank(c["investment_type"]), " Type: ", c["investment_type"]),
        opt(nonblank(c["stage"]), " Stage: ", c["stage"]),
        opt(nonzero(c["post_money"]), " Post-Money Valuation: $", thousands(c["post_money"])),
        opt(nonzero(c["pre_money"]), " Pre-Money Valuation: $", thousands(c["pre_money"])),
        opt(nonblank(c["investors"]), " Investors: ", c["investors"]),
        opt(nonblank(c["short_description"]), " Details: ", c["short_description"]),
    )
