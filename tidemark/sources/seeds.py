"""Reference dimensions: sources, support areas, agents and customer types.

Ids follow the order of the rows, source by source.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The dimension rows.
SOURCES = """
CLIENT_ALPHA|JSON|INCREMENTAL
CLIENT_BETA|XML|INCREMENTAL
CLIENT_GAMMA|CSV|INCREMENTAL
"""

SUPPORT_AREAS = {
    "CLIENT_ALPHA": """
ORDER ISSUES
PRODUCT INQUIRIES
SHIPPING & DELIVERY
ACCOUNT & SECURITY
PAYMENTS & BILLING
RETURNS & REFUNDS
TECHNICAL SUPPORT
PROMOTIONS & DISCOUNTS
PRIME MEMBERSHIP
MARKETPLACE & THIRD-PARTY SELLERS
""",
    "CLIENT_BETA": """
RIDE ISSUES
DRIVER/PASSENGER CONCERNS
PAYMENTS & BILLING
SAFETY & SECURITY
ACCOUNT & PROFILE MANAGEMENT
PROMOTIONS & DISCOUNT
DRIVER SUPPORT
TECHNICAL SUPPORT
CLIENT_BETA EATS
ACCESIBILITY SUPPORT
""",
    "CLIENT_GAMMA": """
ACCOUNT MANAGEMENT
TECHNICAL SUPPORT
SUPPORT OUTAGES
NEW CUSTOMER ONBOARDING
MOBILE & WIRELESS SERVICES
HOME SERVICES
PROMOTIONS & DISCOUNTS
SECURITY & PRIVACY
BUSINESS SERVICES
LOYALTY & RETENTIONS
""",
}

# first name, middle name, last name, code
AGENTS = {
    "CLIENT_ALPHA": """
JOHN|A.|DOE|JDOE
JANE|B.|SMITH|JSMITH
ALICE|C.|JOHNSON|AJOHNSON
BOB|D.|WILLIAMS|BWILLIAMS
CHARLIE|E.|BROWN|CBROWN
DAVID|F.|JONES|DJONES
EVE|G.|GARCIA|EGARCIA
FRANK|H.|MARTINEZ|FMARTINEZ
GRACE|I.|HERNANDEZ|GHERNANDEZ
HANK|J.|LOPEZ|HLOPEZ
""",
    "CLIENT_BETA": """
IVY|K.|GONZALEZ|IGONZALEZ
JACK|L.|WILSON|JWILSON
KARA|M.|ANDERSON|KANDERSON
LEO|N.|THOMAS|LTHOMAS
MIA|O.|TAYLOR|MTAYLOR
NATE|P.|MOORE|NMOORE
OLIVIA|Q.|JACKSON|OJACKSON
PAUL|R.|WHITE|PWHITE
QUINN|S.|HARRIS|QHARRIS
RYAN|T.|MARTIN|RMARTIN
""",
    "CLIENT_GAMMA": """
SARA|U.|THOMPSON|STHOMPSON
TOM|V.|GARCIA|TGARCIA
UMA|W.|MARTINEZ|UMARTINEZ
VICTOR|X.|HERNANDEZ|VHERNANDEZ
WENDY|Y.|LOPEZ|WLOPEZ
XANDER|Z.|GONZALEZ|XGONZALEZ
YARA|A.|WILSON|YWILSON
ZANE|B.|ANDERSON|ZANDERSON
ABBY|C.|THOMAS|ATHOMAS
EDGAR|D.|JONES|EJONES
""",
}

CUSTOMER_TYPES = {
    "CLIENT_ALPHA": """
FIRST-TIME SHOPPER
FREQUENT BUYER
PRIME MEMBER
HIGH-SPENDER
BUDGET SHOPPER
BUSINESS BUYER
TECH-SAVVY BUYER
GIFT GIVER
RETURNS & REFUND SEEKER
COMPLAINT-FOCUSED CUSTOMER
""",
    "CLIENT_BETA": """
FIRST-TIME RIDER
FREQUENT RIDER
COMMUTER
TRAVELER/TOURIST
CLIENT_BETA EATS CUSTOMER
CORPORATE RIDER
DRIVER-PARTNER
PROMO-SEEKER
SAFETY-CONSCIOUS RIDER
ACCESSIBILITY-FOCUSED CUSTOMER
""",
    "CLIENT_GAMMA": """
NEW CUSTOMER
LONG-TERM CUSTOMER
TECH-SAVVY USER
SENIOR CITIZEN
BUSINESS OWNER
FAMILY PLAN MANAGER
FREQUENT TRAVELER
BUDGET-CONSCIOUS CUSTOMER
HEAVY DATA USER
DEVICE ENTHUSIAST
""",
}


def lines(block: str) -> list[list[str]]:
    return [line.split("|") for line in block.strip().splitlines()]


def names(block: str) -> list[str]:
    return [fields[-1] for fields in lines(block)]


def local_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small literal table whose exact size the optimizer knows.

    Built from Arrow so that it becomes a local relation; a list of rows would become
    an RDD of unknown size and never be broadcast on its own.
    """
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return spark.createDataFrame(
        pa.Table.from_pylist(rows, schema=pa.schema([(n, kinds[k]) for n, k in fields]))
    )


def sources(spark: SparkSession) -> DataFrame:
    rows = [
        {
            "source_id": i,
            "source_name": name,
            "source_file_type": kind,
            "data_nature": nature,
            "description": f"CUSTOMER SUPPORT DATA FROM {name} SOURCE",
            "is_active": True,
        }
        for i, (name, kind, nature) in enumerate(lines(SOURCES), 1)
    ]
    return local_table(
        spark,
        rows,
        "source_id int, source_name string, source_file_type string, data_nature string,"
        " description string, is_active boolean",
    )


def seed_dimension(rows: DataFrame, source_table: DataFrame) -> DataFrame:
    """Resolve ``source_name`` of literal rows to ``source_id``; an unknown name gives NULL."""
    ids = source_table.select("source_name", "source_id")
    return rows.join(ids, "source_name", "left").drop("source_name")


def _seed(
    spark: SparkSession, blocks: dict[str, str], columns: list[str], note: str | None, id_name: str
) -> DataFrame:
    rows = [
        dict(zip(columns, fields), source_id=number, is_active=True)
        | ({"description": note.format(source)} if note else {})
        for number, (source, block) in enumerate(blocks.items(), 1)
        for fields in lines(block)
    ]
    for i, row in enumerate(rows, 1):
        row[id_name] = i
    extra = ", description string" if note else ""
    text = "".join(f", {c} string" for c in columns)
    schema = f"{id_name} int{text}, source_id int{extra}, is_active boolean"
    return local_table(spark, rows, schema)


def support_areas(spark: SparkSession) -> DataFrame:
    return _seed(
        spark, SUPPORT_AREAS, ["support_area_name"], "SUPPORT AREA FROM {}", "support_area_id"
    )


def customer_types(spark: SparkSession) -> DataFrame:
    return _seed(
        spark,
        CUSTOMER_TYPES,
        ["customer_type_name"],
        "CUSTOMER TYPE FROM {} SOURCE",
        "customer_type_id",
    )


def agents(spark: SparkSession) -> DataFrame:
    columns = ["first_name", "middle_name", "last_name", "pseudo_code"]
    return _seed(spark, AGENTS, columns, None, "agent_id")


def dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "sources": sources(spark),
        "agents": agents(spark),
        "support_areas": support_areas(spark),
        "customer_types": customer_types(spark),
    }


def field_dictionary(spark: SparkSession) -> DataFrame:
    """Catalog of the fields each source delivers, read off the declared feeds."""
    from tidemark.feeds import FEEDS

    dims = {
        "agent_id": AGENTS,
        "support_area_id": SUPPORT_AREAS,
        "customer_type_id": CUSTOMER_TYPES,
    }
    rows = []
    for spec in FEEDS.values():
        listed = {col: names(dims[dim][spec.source]) for dim, col in spec.lookups.items()}
        for field in spec.raw.fields:
            if field.name in ("_id", "record_id"):
                continue
            allowed = listed.get(field.name.lower())
            rows.append(
                {
                    "data_dictionary_id": len(rows) + 1,
                    "source_name": spec.source,
                    "field_name": field.name.upper(),
                    "data_type": field.dataType.simpleString().upper(),
                    "values_allowed": ", ".join(allowed) if allowed else "ANY",
                    "is_active": True,
                }
            )
    schema = (
        "data_dictionary_id int, source_name string, field_name string, data_type string,"
        " values_allowed string, is_active boolean"
    )
    return seed_dimension(local_table(spark, rows, schema), sources(spark))
