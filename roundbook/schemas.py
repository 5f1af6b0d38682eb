"""Domain schemas and the dotted-name → snake_case renames applied on read.

Source exports flatten structs into dotted column names (``identifier.uuid``);
Spark would read a bare dot as struct access, so names are back-quoted and
renamed once, at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(20, 2)

# Source column → build column, per documented collection.
RENAMES: dict[str, dict[str, str]] = {
    "organizations": {
        "identifier.uuid": "org_uuid",
        "identifier.value": "name",
        "website": "website",
        "website_url": "website_url",
        "description": "description",
        "short_description": "short_description",
        "founded_on.value": "founded_on",
        "categories.value": "categories",
        "category_groups.value": "category_groups",
        "location_identifiers.value": "location",
        "investor_stage": "investor_stage",
        "funding_stage": "funding_stage",
        "funding_total.value_usd": "funding_total_usd",
        "num_funding_rounds": "num_funding_rounds",
        "num_investors": "num_investors",
    },
    "funding_rounds": {
        "identifier.uuid": "round_uuid",
        "identifier.value": "round_name",
        "funded_organization_identifier.uuid": "org_uuid",
        "funded_organization_identifier.value": "org_name",
        "announced_on": "announced_on",
        "closed_on.value": "closed_on",
        "money_raised.value_usd": "amount_usd",
        "money_raised.currency": "currency",
        "investment_type": "investment_type",
        "investment_stage": "stage",
        "num_investors": "num_investors",
        "post_money_valuation.value_usd": "post_money_usd",
        "pre_money_valuation.value_usd": "pre_money_usd",
        "short_description": "short_description",
    },
    "investments": {
        "funding_round_identifier.uuid": "round_uuid",
        "investor_identifier.value": "investor_name",
        "is_lead_investor": "is_lead",
        "money_invested.value_usd": "amount_usd",
    },
    "acquisitions": {
        "identifier.value": "name",
        "acquired_organization_identifier.uuid": "acquired_uuid",
        "acquirer_organization_identifier.uuid": "acquirer_uuid",
        "announced_on": "announced_on",
        "price.value_usd": "price_usd",
    },
}

_S, _D, _L, _B = T.StringType(), T.DateType(), T.LongType(), T.BooleanType()

TYPES: dict[str, dict[str, T.DataType]] = {
    "organizations": {
        "org_uuid": _S, "name": _S, "website": _S, "website_url": _S, "description": _S,
        "short_description": _S, "founded_on": _D, "categories": _S, "category_groups": _S,
        "location": _S, "investor_stage": _S, "funding_stage": _S, "funding_total_usd": MONEY,
        "num_funding_rounds": _L, "num_investors": _L,
    },
    "funding_rounds": {
        "round_uuid": _S, "round_name": _S, "org_uuid": _S, "org_name": _S, "announced_on": _D,
        "closed_on": _D, "amount_usd": MONEY, "currency": _S, "investment_type": _S, "stage": _S,
        "num_investors": _L, "post_money_usd": MONEY, "pre_money_usd": MONEY, "short_description": _S,
    },
    "investments": {"round_uuid": _S, "investor_name": _S, "is_lead": _B, "amount_usd": MONEY},
    "acquisitions": {"name": _S, "acquired_uuid": _S, "acquirer_uuid": _S, "announced_on": _D, "price_usd": MONEY},
}


def source_schema(collection: str, header: list[str]) -> T.StructType:
    """Read schema for a CSV whose header is ``header`` (source names).

    Documented columns get their declared type; any other column is a string.
    Declaring the schema avoids a mis-inferred date reaching date arithmetic.
    """
    names = RENAMES.get(collection, {})
    types = TYPES.get(collection, {})
    fields = []
    for h in header:
        t = types.get(names.get(h, ""), T.StringType())
        fields.append(T.StructField(h, t, True))
    return T.StructType(fields)


def to_domain(df: DataFrame, collection: str) -> DataFrame:
    """Rename dotted source columns to build names; other columns pass through.

    Documented columns missing from the source are added as typed NULLs so
    every operator can rely on the domain schema.
    """
    names = RENAMES.get(collection)
    if not names:
        return df
    out = []
    present = set(df.columns)
    for src, dst in names.items():
        if src in present:
            out.append(F.col(f"`{src}`").cast(TYPES[collection][dst]).alias(dst))
        else:
            out.append(F.lit(None).cast(TYPES[collection][dst]).alias(dst))
    extra = [F.col(f"`{c}`").alias(c.replace(".", "_")) for c in df.columns if c not in names]
    return df.select(*out, *extra)
