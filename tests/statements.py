"""Small statement tables."""

import datetime as dt
from decimal import Decimal

SCHEMA = (
    "stmt_id bigint, cik string, filing_date date, filing_type string, filing_href string, fpe_date date, fiscal_year decimal(4,0), "
    "fiscal_quarter decimal(1,0), fiscal_period string, item string, item_value decimal(20,5), item_rank decimal(2,0), table_rank decimal(2,0), "
    "src_table string, src_row string, src_column string, src_value string, src_units string, is_overridden boolean, loaded_at timestamp"
)
NAMES = [x.strip().split()[0] for x in SCHEMA.replace("decimal(4,0)", "d").replace("decimal(1,0)", "d").replace("decimal(20,5)", "d").replace("decimal(2,0)", "d").split(",")]

REFS = [
    (101, "item", "net income"), (102, "item", "net interest income"), (103, "item", "interest income"), (104, "item", "provision for loan losses"),
    (105, "item", "total revenue"), (106, "item", "book value per share"), (107, "src_row", "Net income"), (127, "src_row", "Provision for loan losses"),
    (146, "src_table", "Consolidated balance sheets"), (161, "src_table", "Résumé of quarterly results"),
]


def refs(spark):
    return spark.createDataFrame(REFS, "ref_id bigint, field string, label string")


def frame(spark, rows):
    """Rows given as dicts; what is not given is null but for the key parts."""
    base = {"cik": "0009000001", "filing_date": dt.date(2015, 5, 1), "filing_type": "8-K", "filing_href": "h", "item": "net income", "fiscal_period": "2015Q1"}
    out = []
    for i, r in enumerate(rows):
        full = {"stmt_id": i + 1, **base, **r}
        if full.get("item_value") is not None:
            full["item_value"] = Decimal(str(full["item_value"]))
        for k in ("item_rank", "table_rank"):
            if full.get(k) is not None:
                full[k] = Decimal(full[k])
        out.append(tuple(full.get(n) for n in NAMES))
    return spark.createDataFrame(out, SCHEMA)
