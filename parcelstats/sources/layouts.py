"""Fixed-width layouts of the raw extracts (SRC-5..8)."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Field names with their first character position, counted from 1. A
# field reaches to the start of the next one, the last field to the end of the line.
# ---------------------------------------------------------------------------
ASSESSMENTS = {
    "tmk": 1, "parcel_year": 14, "land_class": 19, "tax_rate_class": 23,
    "assessed_land_value": 27, "land_exemption": 40, "assessed_building_value": 53,
    "building_exemption": 66,
}

DWELLINGS = {
    "tmk": 1, "parcel_year": 14, "card_number": 19, "story_height": 24, "exterior_wall": 31,
    "framing": 34, "style_occupancy": 37, "roof_design": 39, "full_baths": 42, "half_baths": 49,
    "additional_fixtures": 56, "total_fixtures": 63, "air_conditioning": 69, "attic": 70,
    "total_rooms": 71, "bed_rooms": 76, "family_rooms": 81, "foundation": 86, "basement": 89,
    "construction": 90, "flooring": 92, "interior_wall_structure": 95, "roof_material": 98,
    "interior_wall_material": 101, "condo_floor_level": 104, "condo_type": 112, "condo_view": 115,
    "condo_parking_spaces": 118, "condo_style": 121, "duplex": 124, "year_built": 127,
    "effective_year_built": 132, "physical_condition": 137, "building_grade": 138,
    "building_shape_factor": 141, "percent_complete": 144, "ceiling_material": 155,
    "sf_of_living_area": 158, "sf_of_bldg_foot_print": 165, "addition_living_area_in_sf": 173,
    "building_value": 181, "built_in_fire_place_linear_feet": 192, "no_prefab_fire_places": 198,
    "no_wood_burning_fire_places": 200, "cost_and_design_adjustment": 202,
}

OWNERS = {
    "tmk": 1, "owner": 14, "owner_type": 54, "co_mailing_address": 94,
    "mailing_street_address": 215, "mailing_city_state_zip": 295, "mailing_city_name": 387,
    "mailing_state": 427, "mailing_zip1": 429, "mailing_zip2": 434, "country": 438,
}

# The sales file names its fields itself.
SALES_STARTS = [1, 19, 30, 41, 52, 73, 114, 155, 196, 205, 214, 255, 296, 337, 340]
SALES_HEADER_PREFIX = "PARID"
SALES_FOOTER_TEXT = "rows select"

# Characters of windows-1252 bytes 0x80-0x9F; the five undefined bytes pass through.
WINDOWS_1252_C1 = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡",
    0x88: "ˆ", 0x89: "‰", 0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘",
    0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—", 0x98: "˜",
    0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
# ---------------------------------------------------------------------------


def fields(layout: dict[str, int]) -> list[tuple[str, int]]:
    """(name, start) pairs of a layout."""
    return list(layout.items())


def spans(starts: list[int]) -> list[tuple[int, int | None]]:
    """(start, width) of each field; the width of the last one is open."""
    ends = [*starts[1:], None]
    return [(start, None if end is None else end - start) for start, end in zip(starts, ends)]
