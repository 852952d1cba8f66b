"""Schemas of the snapshot documents, as Spark DDL text."""

# The layout of one snapshot document. The feed sends these
# fields under these names, so they are listed here as they arrive.
BIKE_TYPES = "struct<`150`: bigint, `297`: bigint, undefined: bigint>"

POINT = "struct<lat: double, lng: double>"

BIKE = """struct<
    active: boolean, battery_pack: string, bike_type: bigint, boardcomputer: bigint,
    electric_lock: boolean, lock_types: array<string>, number: string,
    pedelec_battery: string, state: string>"""

PLACE = f"""struct<
    address: string, bike: boolean, bike_list: array<{BIKE}>,
    bike_numbers: array<string>, bike_racks: bigint, bike_types: {BIKE_TYPES},
    bikes: bigint, bikes_available_to_rent: bigint, booked_bikes: bigint,
    free_racks: bigint, free_special_racks: bigint, lat: double, lng: double,
    maintenance: boolean, name: string, number: bigint, place_type: string,
    rack_locks: boolean, special_racks: bigint, spot: boolean,
    terminal_type: string, uid: bigint>"""

CITY = f"""struct<
    alias: string, available_bikes: bigint, bike_types: {BIKE_TYPES},
    booked_bikes: bigint, bounds: struct<north_east: {POINT}, south_west: {POINT}>,
    `break`: boolean, lat: double, lng: double, maps_icon: string, name: string,
    num_places: bigint, places: array<{PLACE}>, refresh_rate: string,
    return_to_official_only: boolean, set_point_bikes: bigint, uid: bigint,
    website: string, zoom: bigint>"""

COUNTRY = f"""struct<
    available_bikes: bigint, booked_bikes: bigint, capped_available_bikes: boolean,
    cities: array<{CITY}>, country: string, country_calling_code: string,
    country_name: string, currency: string, domain: string, email: string,
    faq_url: string, hotline: string, language: string, lat: double, lng: double,
    name: string, no_registration: boolean, policy: string, pricing: string,
    set_point_bikes: bigint, show_bike_type_groups: boolean, show_bike_types: boolean,
    show_free_racks: boolean, store_uri_android: string, store_uri_ios: string,
    system_operator_address: string, terms: string, timezone: string, vat: string,
    website: string, zoom: bigint>"""

DOCUMENT = f"countries array<{COUNTRY}>"

# The part of a document that the snapshot table needs. Reading JSON with this
# schema skips the other fields in the parser, which the full one cannot.
READING_DOCUMENT = """countries array<struct<cities: array<struct<places: array<struct<
    bike: boolean, bikes: bigint, lat: double, lng: double, maintenance: boolean,
    name: string, number: bigint, spot: boolean>>>>>>"""

SNAPSHOT_COLUMNS = (
    "ts", "station_id", "bikes", "maintenance", "station_name", "lat", "lng",
)
