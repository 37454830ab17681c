"""Fixed values of the method: factor tables, country rectangles, word lists.

Every value here has to be exact for the results to be right; nothing is derived.
"""

# --- fixed values: geography -------------------------------------------------
EARTH_RADIUS_KM = 6371.0
AIRPORT_RADIUS_KM = 50.0
AIRPORT_BAND_DEG = 1.0
MIN_FLIGHT_KM = 100.0
MIN_TRAIN_KM = 100.0
LONG_DISTANCE_KM = 100.0
SUBSTITUTION_LIMIT_KM = 600.0

# --- fixed values: carbon ----------------------------------------------------
TRAIN_WH_PER_PKM = 88.2
KEROSENE_KG_CO2_PER_KG = 3.78
DEFAULT_ELECTRICITY = 0.40

# kg CO2 per kWh of traction electricity, by country
ELECTRICITY = {
    "AT": 0.18, "BA": 1.17, "BE": 0.22, "BG": 0.87, "CH": 0.01, "CZ": 0.77, "DE": 0.65,
    "DK": 0.48, "EE": 1.38, "GR": 0.88, "ES": 0.34, "FI": 0.29, "FR": 0.09, "HR": 0.36,
    "HU": 0.48, "IE": 0.57, "IT": 0.51, "LT": 0.53, "LU": 0.42, "LV": 0.29, "ME": 0.59,
    "NL": 0.57, "NO": 0.01, "PL": 1.09, "PT": 0.42, "RO": 0.58, "RS": 1.18, "RU": 0.76,
    "SE": 0.03, "SI": 0.43, "SK": 0.28, "TR": 0.75, "GB": 0.60,
}

# step tables: (largest km of the step, value); None is "no upper bound"
KEROSENE_G_PER_SEAT_KM = [
    (187.5, 120.5), (312.5, 75.7), (437.5, 60.1), (562.5, 42.7),
    (687.5, 38.4), (875.0, 36.0), (1000.0, 33.2), (None, 19.0),
]
LOAD_FACTOR = [(375.0, 0.71), (625.0, 0.75), (None, 0.80)]
RADIATIVE_FORCING = [(499.0, 1.0), (624.0, 1.27), (749.0, 1.47), (999.0, 1.60), (None, 1.87)]

# country rectangles, first hit wins: code, lat min, lat max, lon min, lon max (all inclusive)
COUNTRY_RECTANGLES = [
    ("LU", 49.4, 50.2, 5.7, 6.5), ("BE", 49.5, 51.5, 2.5, 6.4), ("NL", 50.8, 53.6, 3.3, 7.2),
    ("CH", 45.8, 47.8, 6.0, 10.5), ("SI", 45.4, 46.9, 13.4, 16.6), ("ME", 41.8, 43.6, 18.4, 20.4),
    ("SK", 47.7, 49.6, 16.8, 22.6), ("HU", 45.7, 48.6, 16.1, 22.9), ("AT", 46.4, 49.0, 9.5, 17.2),
    ("CZ", 48.6, 51.1, 12.1, 18.9), ("PT", 36.9, 42.2, -9.5, -6.2), ("IE", 51.4, 55.4, -10.5, -6.0),
    ("EE", 57.5, 59.7, 21.5, 28.2), ("LV", 55.7, 58.1, 21.0, 28.2), ("LT", 53.9, 56.4, 21.0, 26.8),
    ("BA", 42.6, 45.3, 15.7, 19.6), ("RS", 42.2, 46.2, 19.0, 23.0), ("HR", 42.4, 46.6, 13.5, 19.4),
    ("GR", 35.0, 41.8, 20.0, 26.6), ("BG", 41.2, 44.2, 22.4, 28.6), ("RO", 43.6, 48.3, 20.2, 29.7),
    ("PL", 49.0, 54.8, 14.1, 24.1), ("DK", 54.6, 57.8, 8.1, 15.2), ("FI", 59.8, 70.1, 20.0, 31.6),
    ("NO", 57.9, 71.2, 4.5, 31.1), ("SE", 55.3, 69.1, 11.0, 24.2), ("GB", 49.9, 60.9, -8.2, 1.8),
    ("ES", 36.0, 43.8, -9.3, 3.3), ("IT", 36.6, 47.1, 6.6, 18.5), ("DE", 47.3, 55.1, 5.9, 15.0),
    ("FR", 41.3, 51.1, -5.1, 9.6), ("TR", 36.0, 42.1, 26.0, 44.8), ("RU", 41.2, 70.0, 28.0, 180.0),
]

# --- fixed values: trains ----------------------------------------------------
PLANE = "Avion"
RAIL_ROUTE_TYPE = 2
RAIL_ROUTE_TYPE_RANGE = (100, 117)
NIGHT_ROUTE_TYPE = 102

# pattern on the upper-cased service code -> type, first hit wins
SERVICE_PATTERNS = [
    ("TGV|INOUI", "TGV"),
    ("ICE", "ICE"),
    ("AVE", "AVE"),
    ("FRECCIAROSSA|FRECCIARGENTO|FRECCIABIANCA", "Frecciarossa"),
    ("^IC$|INTERCITY", "InterCity"),
    ("^EC$|EUROCITY", "EuroCity"),
    ("EN|EURONIGHT", "EuroNight"),
    ("NJ|NIGHTJET", "Nightjet"),
]
# the same services matched as whole words (optional strict mode)
STRICT_SERVICE_PATTERNS = [
    (r"\b(TGV|INOUI)\b", "TGV"),
    (r"\bICE\b", "ICE"),
    (r"\bAVE\b", "AVE"),
    (r"\b(FRECCIAROSSA|FRECCIARGENTO|FRECCIABIANCA)\b", "Frecciarossa"),
    (r"\b(IC|INTERCITY)\b", "InterCity"),
    (r"\b(EC|EUROCITY)\b", "EuroCity"),
    (r"\b(NJ|NIGHTJET)\b", "Nightjet"),
    (r"\b(EN|EURONIGHT)\b", "EuroNight"),
]
NIGHT_SHEET_PATTERN = ("INTERCITÉS.*NUIT", "Intercités Nuit")
NIGHT_TYPES = ["Train Nuit", "EuroNight", "Nightjet"]
NIGHT_TYPES_DASHBOARD = [
    "EuroNight", "Nightjet", "Train Nuit", "Intercités Nuit", "Train Longue Distance Nuit",
    "TGV Nuit", "ICE Nuit", "InterCity Nuit", "EuroCity Nuit",
]
FIRST_NIGHT_HOUR = 22
LAST_NIGHT_HOUR = 6

# kg CO2 factor stored with a vehicle type; every other type has the default
VEHICLE_FACTOR = {
    "TGV": 0.29, "ICE": 0.29, "AVE": 0.29, "Frecciarossa": 0.29, "Frecciargento": 0.29,
}
DEFAULT_VEHICLE_FACTOR = 0.9

# --- fixed values: names and sources ----------------------------------------
NAME_PREFIXES = [
    "GARE DE ", "GARE D ", "GARE DU ", "GARE DES ",
    "AEROPORT DE ", "AEROPORT D ", "AEROPORT DU ",
]
AIRPORT_CATEGORIES = ["large_airport", "medium_airport", "small_airport"]
SHEET_SENTINEL = "#N/A"
FEED_EXCLUDE_WORDS = ["bus", "shuttle", "tram", "metro", "urbain", "autocar", "car"]
GAZETTEER_COUNTRIES = [
    "FR", "DE", "CH", "AT", "BE", "NL", "ES", "IT", "PT", "GB", "IE", "SE", "NO", "DK", "FI", "PL",
    "CZ", "SK", "HU", "RO", "BG", "HR", "SI", "RS", "BA", "ME", "GR", "LU", "LV", "LT", "EE", "TR",
]

# source column -> our column
COLUMN_NAMES = {
    "airports": {
        "latitude_deg": "aero_lat", "longitude_deg": "aero_long", "type": "category",
        "name": "airport_name", "iso_country": "country_code",
    },
    "stops": {"stop_lat": "station_lat", "stop_lon": "station_long", "stop_name": "station_name"},
    "routes": {"route_type": "vehicule_type"},
}
