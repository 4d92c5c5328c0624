"""Lookup values and default parameters of the published statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# They decide results and must stay as they are.
# ---------------------------------------------------------------------------
COUNTY = "Maui County"
STATE = "Hawaii"

PARCEL_KEY_DIGITS = 13
SALE_COUNTY_DIGIT = "2"
MIN_AREA = 200
MIN_PRICE = 20000
FIRST_SALE_YEAR, LAST_SALE_YEAR = 1984, 2024
FIRST_BUILT_YEAR, LAST_BUILT_YEAR = 1970, 2023
AFFORDABLE_RATIO = 5
PROPERTY_BASE_YEAR = 2023
INCOME_BASE_YEAR = 2020
INTERPOLATED_INCOME_BASE_YEAR = 2023
REFERENCE_SWITCH_YEAR = 2000
LANAI_FIRST_YEAR = 1990

RESIDENTIAL_CLASSES = ["owner-occupied", "non-owner-occupied", "tvr-strh", "long-term-rental"]
RESIDENT_CLASSES = ["owner-occupied", "long-term-rental"]

# Tax class labels; the class number is the position.
TAX_CLASS_LABELS = [
    "timeshare",
    "non-owner-occupied",
    "apartment",
    "commercial",
    "industrial",
    "agricultural",
    "conservation",
    "hotel/resort",
    "",
    "owner-occupied",
    "commercialized-res",
    "tvr-strh",
    "long-term-rental",
]

# Region, flag column, zone-section codes. The first matching row names the region.
ZONE_REGIONS = [
    ("West Maui", "is_lahaina", [45, 46]),
    ("West Maui", "is_west_maui", list(range(41, 49))),
    ("Central Maui", "is_central_maui", list(range(31, 39))),
    ("Upcountry", "is_upcountry", list(range(22, 30))),
    ("South Maui", "is_south_maui", [21, 39]),
    ("East Maui", "is_east_maui", list(range(11, 20))),
    ("Molokai", "is_molokai", list(range(50, 60))),
    ("Lanai", "is_lanai", [49]),
]
REGIONS = sorted({region for region, _, _ in ZONE_REGIONS})

LOCAL_POSTAL_CODES = [
    96708, 96713, 96729, 96732, 96733, 96742, 96748, 96753, 96757, 96761,
    96763, 96767, 96768, 96770, 96779, 96784, 96788, 96790, 96793,
]

# Census tract -> region.
TRACT_REGIONS = {
    30100: "East Maui",
    30200: "Upcountry",
    30300: "Upcountry",
    30301: "Upcountry",
    30302: "South Maui",
    30303: "South Maui",
    30304: "Upcountry",
    30305: "Upcountry",
    30306: "South Maui",
    30307: "South Maui",
    30400: "Upcountry",
    30500: "Upcountry",
    30600: "Upcountry",
    30700: "South Maui",
    30800: "Central Maui",
    30900: "Central Maui",
    31000: "Central Maui",
    31100: "Central Maui",
    31200: "Central Maui",
    31300: "Central Maui",
    31400: "West Maui",
    31500: "West Maui",
    31600: "Lanai",
    31700: "Molokai",
    31800: "Molokai",
    31900: "Upcountry",
    32000: "West Maui",
}

# Complexes allowed as short-term rentals: eight-digit parcel prefix, name.
SPECIAL_COMPLEXES = {
    14005040: "HANA KAI-MAUI",
    21008060: "WAILEA EKAHI II",
    21008064: "WAILEA EKAHI I",
    21008065: "WAILEA EKAHI III",
    21008077: "WAILEA EKOLU",
    21008082: "PALMS AT WAILEA I",
    21008104: "GRND CHAMP VILLAS",
    26012050: "KUAU PLAZA",
    38014001: "MAKANI A KAI",
    38014002: "HONO KAI",
    38014004: "KANAI A NALU",
    38014011: "MAALAEA BANYANS",
    38014015: "ISLAND SANDS",
    38014016: "LAULOA MAALAEA",
    38014021: "MAALAEA KAI",
    38014022: "MILOWAI-MAALAEA",
    39001002: "MAUI SUNSET",
    39001004: "MAUI SCHOONER",
    39001006: "LUANA KAI",
    39001057: "WAIPUILANI",
    39001075: "KAUHALE MAKAI",
    39001107: "KIHEI BAY SURF",
    39001110: "LEINAALA",
    39001134: "KOA RESORT II",
    39001136: "KIHEI RESORT",
    39001143: "KIHEI BAY VISTA",
    39004004: "KAMAOLE SANDS",
    39004081: "MAUI HILL",
    39004082: "MAUI KAMAOLE III",
    39004084: "HALE KAMAOLE",
    39004097: "HALEAKALA SHORES",
    39004098: "MAUI PARKSHORE",
    39004139: "KEAWAKAPU",
    39004143: "MAUI KAMAOLE",
    39004144: "MAUI KAMAOLE II",
    39005012: "MY WAII BEACH COTTAGE",
    39005013: "WAILEA INN",
    39005017: "LIHIKAI APTS",
    39005018: "KIHEI COVE",
    39005021: "HALE MAHIALANI",
    39005022: "INDO LOTUS BEACH HSE",
    39005023: "KAMAOLE ONE",
    39005035: "HALE ILIILI",
    39005038: "PUNAHOA BEACH APTS",
    39005039: "2131 ILIILI RD",
    39007001: "1194 ULUNIU RD",
    39007002: "1178 ULUNIU RD",
    39007025: "MOANA VILLA",
    39008003: "HALE KAI O'KIHEI",
    39008009: "LEILANI KAI",
    39008011: "KIHEI GARDEN ESTATES",
    39008031: "ALOHA VILLAS",
    39009002: "1444 HALAMA ST",
    39009003: "1440 HALAMA ST",
    39009005: "KAPU TOWNHOUSE",
    39009010: "WAIOHULI BCH DUPLEX",
    39009025: "1470 HALAMA ST",
    39009029: "WAIOHULI BEACH HALE",
    39016020: "KIHEI VILLA",
    39016027: "KALAMA TERRACE",
    39017003: "SHORES OF MAUI",
    39017010: "KIHEI PARKSHORE",
    39017017: "KANOE APTS",
    39018002: "PACIFIC SHORES",
    39018003: "MAUI VISTA",
    42001024: "KAPALUA BAY VILLAS",
    42001028: "KAPALUA GOLF VILLAS",
    42001032: "THE RIDGE",
    43005009: "KAHANA REEF",
    43005020: "KAHANA OUTRIGGER",
    43005021: "KAHANA OUTRIGGER",
    43005029: "KAHANA VILLAGE",
    43005031: "KAHANA OUTRIGGER",
    43006006: "LAHAINA BEACH CLUB",
    43006007: "NOHONANI",
    43006012: "MAKANI SANDS",
    43006013: "KALEIALOHA",
    43006014: "HONO KOA",
    43006016: "LOKELANI",
    43006041: "HALE MAHINA BEACH",
    43006044: "HALE ONO LOA",
    43006063: "PIKAKE",
    43008001: "MAHINAHINA BEACH",
    43008002: "POLYNESIAN SHORES",
    43008004: "KULEANA",
    43008005: "KULEANA",
    43008006: "HOYOCHI NIKKO",
    43009002: "NOELANI",
    43009005: "MAHINA SURF",
    44001041: "HONOKOWAI PALMS",
    44001042: "HALE KAI I",
    44001050: "PAKI MAUI III",
    44001051: "PAKI MAUI I & II",
    44001052: "MAUI SANDS I",
    44001055: "PAPAKEA",
    44001071: "MAUI SANDS II",
    44006011: "HALE KAANAPALI",
    44008021: "MAUI ELDORADO",
    44008023: "KAANAPALI ROYAL",
    45004002: "PUUNOA BEACH ESTATES",
    45013027: "LAHAINA ROADS",
    46010002: "THE SPINNAKER",
    51003013: "KENANI KAI",
    56004055: "WAVECREST",
}

# Names of the condominium subsets.
SPECIAL_CONDOS = "west-south-maui-minatoya-condos"
OTHER_CONDOS = "west-south-maui-non-minatoya-condos"
CENTRAL_CONDOS = "central-maui-condos"
# ---------------------------------------------------------------------------


def lookup(pairs: dict[int, str], key: Column) -> Column:
    """Literal map lookup; null for a missing key."""
    entries = [F.lit(item) for pair in pairs.items() for item in pair]
    return F.element_at(F.create_map(*entries), key)


def special_complexes(spark: SparkSession) -> DataFrame:
    """The built-in complexes as (tmk_sub, complex_name); one row per listed line."""
    return spark.createDataFrame(
        list(SPECIAL_COMPLEXES.items()), "tmk_sub bigint, complex_name string"
    )
