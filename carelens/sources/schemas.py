"""Canonical input schemas and the raw -> canonical column names.

Types are declared, never inferred.  Keys are text; timestamps are zone-free.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


INSTALLS = _schema(
    ("zzsoldto", S),
    ("zzr3serNo", S),
    ("zz0012", S),
    ("zz0010", S),
    ("zzpurchaseDate", TS),
    ("zzinstallDate", TS),
    ("zzstartDate", TS),
    ("zzendDate", TS),
    ("zzr3matId", S),
)

CALLS = _schema(
    ("CustomerCode", S),
    ("ProductSerial", S),
    ("Status", S),
    ("Origin", S),
    ("Medium", S),
    ("ServiceType", S),
    ("MachineStatus", S),
    ("Esclationlevel", D),
    ("npSrating", D),
    ("PostingDate", TS),
    ("SoftClosureDate", TS),
    ("ClosedOn", TS),
    ("NegativeResponseRemarks", S),
    ("NegativeReponseRemarksDate", TS),
)

CONTRACTS = _schema(
    ("CustomerCode", S),
    ("SrNo", S),
    ("IcrNo", S),
    ("AmcType", S),
    ("AMCPostingDate", TS),
    ("ContStrtDat", TS),
    ("ContEndDat", TS),
    ("Price", D),
    ("WarConv", S),
)

SPARES = _schema(
    ("CustomerC", S),
    ("Serial", S),
    ("ItemNo", S),
    ("NetValue", D),
    ("ItemCategory", S),
    ("CallBookDate", TS),
)

CALL_ITEMS = _schema(
    ("CustomerCode", S),
    ("ProductSerial", S),
    ("PostingDate", TS),
    ("Qty", D),
    ("itemtype", S),
    ("Accessories", S),
    ("Additive", S),
)

PRICE_RATIO = _schema(
    ("Mat_ID1", S),
    ("Mat_ID1_price", D),
    ("Relative_ratio", D),
)

SCHEMAS: dict[str, T.StructType] = {
    "installs": INSTALLS,
    "calls": CALLS,
    "contracts": CONTRACTS,
    "spares": SPARES,
    "call_items": CALL_ITEMS,
    "price_ratio": PRICE_RATIO,
}

# Column names as the upstream files spell them -> canonical names.
RAW_NAMES: dict[str, dict[str, str]] = {
    "installs": {
        "zzpurchase_date": "zzpurchaseDate",
        "zzinstall_date": "zzinstallDate",
        "warranty_sdate": "zzstartDate",
        "warranty_edate": "zzendDate",
        "zzr3mat_id": "zzr3matId",
        "zzr3ser_no": "zzr3serNo",
    },
    "spares": {
        "CustomerCode": "CustomerC",
        "ProductSerial": "Serial",
        "MATERIAL": "ItemNo",
        "COGS": "NetValue",
        "MACHSTAT": "ItemCategory",
    },
    "call_items": {
        "SOLD_TO_PARTY": "CustomerCode",
        "ZZSERIAL_NUMB": "ProductSerial",
        "POSTING_DATE": "PostingDate",
        "Quantity": "Qty",
    },
    "calls": {},
    "contracts": {},
    "price_ratio": {},
}

# Date patterns tried after the ISO forms when text dates are parsed.  None of
# them is ambiguous; a source that writes day or month first says so.
DEFAULT_TS_FORMATS = ("yyyyMMdd",)


def _with_times(*dates: str) -> tuple[str, ...]:
    return tuple(f"{d}{t}" for d in dates for t in (" HH:mm:ss", " HH:mm", ""))


DAY_FIRST = _with_times("dd/MM/yyyy", "dd-MM-yyyy", "dd.MM.yyyy")
MONTH_FIRST = _with_times("MM/dd/yyyy", "MM-dd-yyyy")
