"""The export collections: names and display names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values that must equal the reference: collection key → display name,
# in the reference's order.
COLLECTIONS: dict[str, str] = {
    "acquisition_predictions": "Acquisition Predictions",
    "acquisitions": "Acquisitions",
    "addresses": "Addresses",
    "awards": "Awards",
    "categories": "Categories",
    "category_groups": "Category Groups",
    "closure_predictions": "Closure Predictions",
    "degrees": "Degrees",
    "diversity_spotlights": "Diversity Spotlights",
    "event_appearances": "Event Appearances",
    "events": "Events",
    "funds": "Funds",
    "funding_predictions": "Funding Predictions",
    "funding_rounds": "Funding Rounds",
    "growth_insights": "Growth Insights",
    "growth_predictions": "Growth Predictions",
    "investments": "Investments",
    "investor_insights": "Investor Insights",
    "ipo_predictions": "IPO Predictions",
    "ipos": "IPOs",
    "jobs": "Jobs",
    "key_employee_changes": "Key Employee Changes",
    "layoffs": "Layoffs",
    "layoff_predictions": "Layoff Predictions",
    "legal_proceedings": "Legal Proceedings",
    "locations": "Locations",
    "organizations": "Organizations",
    "ownerships": "Ownerships",
    "partnership_announcements": "Partnership Announcements",
    "people": "People",
    "press_references": "Press References",
    "principals": "Principals",
    "products": "Products Insights",
    "product_launches": "Product Launches",
}


def expected_collections(spark: SparkSession) -> DataFrame:
    """``(collection, display_name)`` for every known collection (34 rows)."""
    return spark.createDataFrame(list(COLLECTIONS.items()), "collection string, display_name string")
