import math

import pytest
from pyspark.sql import functions as F

from railmart.functions import carbon, geo, text, trains
from tests.helpers import apply

PLANE = {
    100: 64.1535, 187.5: 120.2879, 187.6: 75.6070, 312.5: 125.9445, 375: 119.9884, 375.1: 113.6193,
    437.5: 132.5205, 499: 107.3888, 499.5: 136.5204, 562.5: 153.7392, 624: 153.3734, 624.5: 177.6690,
    625: 177.8112, 687.5: 183.3678, 749: 187.2852, 875: 238.1400, 999: 250.7410, 1000: 293.3469,
    1000.1: 167.8960, 1390.3: 233.4025,
}
COUNTRIES = [
    (48.84, 2.37, "FR"), (45.76, 4.86, "FR"), (50.64, 3.07, "BE"), (48.58, 7.73, "DE"),
    (43.61, 1.45, "ES"), (49.11, 6.18, "DE"), (46.21, 6.14, "CH"), (48.14, 11.56, "AT"),
    (51.04, 13.73, "CZ"), (48.19, 16.38, "HU"), (52.52, 13.37, "DE"), (45.49, 9.20, "IT"),
    (47.38, 8.54, "CH"), (47.55, 7.59, "CH"), (40.41, -3.69, "ES"), (38.71, -9.12, "PT"),
    (55.67, 12.56, "DK"), (42.70, 2.88, "ES"), (64.1, -21.9, None), (0.0, 0.0, None),
    (None, 2.0, None),
]


def test_plane_co2_on_both_sides_of_each_step(spark):
    got = apply(spark, [(float(d),) for d in PLANE], carbon.plane_co2, "double")
    assert got == pytest.approx(list(PLANE.values()), abs=5e-5)


def test_plane_co2_needs_a_positive_distance(spark):
    assert apply(spark, [(None,), (0.0,), (-1.0,)], carbon.plane_co2, "double") == [None] * 3


def test_country_is_first_rectangle(spark):
    got = apply(spark, [c[:2] for c in COUNTRIES], geo.country_of, "double")
    assert got == [c[2] for c in COUNTRIES]


def test_haversine(spark):
    paris, lyon = (48.8443, 2.3744), (45.7605, 4.8597)
    got = apply(
        spark,
        [(*paris, *lyon), (*lyon, *paris), (*paris, *paris), (*paris, None, 1.0), (0.0, 0.0, 0.0, 180.0)],
        geo.haversine,
        "double",
    )
    assert got[0] == pytest.approx(390.7184, abs=5e-5)
    assert got[0] == pytest.approx(got[1], abs=1e-9)
    assert got[2:4] == [0.0, None]
    assert got[4] == pytest.approx(math.pi * 6371.0)


def test_train_co2_by_origin_country(spark):
    got = apply(
        spark,
        [(390.7184, "TGV", 48.8443, 2.3744), (100.0, "TGV", 64.1, -21.9), (100.0, None, 48.0, 2.0),
         (0.0, "TGV", 48.0, 2.0), (100.0, "Avion", 48.0, 2.0), (100.0, "TGV", None, None)],
        carbon.co2_kg,
        ["double", "string", "double", "double"],
    )
    assert got == pytest.approx([3.1015, 3.528, None, None, 64.1535, 3.528], abs=5e-5)


def test_substitutable(spark):
    got = apply(spark, [(600.0, 1.0), (600.1, 1.0), (10.0, None), (None, 1.0)], carbon.is_substitutable, "double")
    assert got == [1, 0, 0, 0]


def test_clean_station(spark):
    cases = {
        "Lyon  Part-Dieu (FR)": "Lyon Part-Dieu", "Basel [SBB]": "Basel",
        "Halle (Saale)": "Halle (Saale)", "Frankfurt(Main)Hbf": "Frankfurt(Main)Hbf",
    }
    assert apply(spark, [(k,) for k in cases], text.clean_station) == list(cases.values())


def test_fold_name(spark):
    cases = {
        "Besançon–Zürich": "BESANCON–ZURICH", "Saint-Étienne_Gare": "SAINT ETIENNE GARE",
        "Łódź": "ŁODZ", None: "", "straße": "STRASSE", "éa": "EA", "Αθήνα": "ΑΘΗΝΑ",
        "Việt": "VIET",
    }
    assert apply(spark, [(k,) for k in cases], text.fold_name) == list(cases.values())


def test_fold_name_equals_unicode_decomposition(spark):
    import unicodedata

    points = [chr(p) for p in range(0x20, 0x110000) if unicodedata.category(chr(p)) not in ("Cn", "Cc", "Cs", "Co")]
    words = ["x" + c + "y" for c in points] + ["\u2003 x\u3000", "\x1dx\n"]

    def plain(s):
        s = "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
        return s.upper().replace("-", " ").replace("_", " ").strip()

    got = apply(spark, [(w,) for w in words], text.fold_name)
    differing = [w for w, g in zip(words, got) if g != plain(w)]
    # only letters whose upper-case form differs between the JVM's and Python's Unicode version
    odd = [w for w in differing if plain(w) == w.upper().replace("-", " ").strip() and len(w) == 3]
    assert len(differing) == len(odd) <= 100, differing[:20]


@pytest.mark.parametrize(
    "code, route_type, want",
    [
        ("TGV INOUI", 2, "TGV"), ("ICE 71", 2, "ICE"), ("NICE", 2, "ICE"), ("BREMEN", 2, "EuroNight"),
        ("IC", 2, "InterCity"), ("IC 123", 2, "Train Longue Distance"), ("NJ 40", 2, "Nightjet"),
        (None, 2, "Train Longue Distance"), ("RE", 102, "Train Nuit"),
    ],
)
def test_classify_timetable(spark, code, route_type, want):
    got = apply(
        spark, [(code, route_type)],
        lambda c, t: trains.classify_timetable(trains.service_code(c), t), ["string", "int"],
    )
    assert got == [want]


def test_classify_strict_matches_words(spark):
    got = apply(
        spark, [("NICE", 2), ("BREMEN", 2), ("IC 123", 2), ("EN NJ 40", 2)],
        lambda c, t: trains.classify_timetable(c, t, strict=True), ["string", "int"],
    )
    assert got == ["Train Longue Distance", "Train Longue Distance", "InterCity", "Nightjet"]


def test_classify_sheet(spark):
    got = apply(
        spark,
        [("Intercités de Nuit", "x"), (None, "102"), (None, "2"), ("ABC", "zzz")],
        lambda c, t: trains.classify_sheet(trains.service_code(c, t), t),
    )
    assert got == ["Intercités Nuit", "Train Nuit", "InterCity", "InterCity"]


def test_hour_and_night(spark):
    times = ["22:00:00", "06:59:00", "07:00:00", "25:10:00", "9:05:00", " 9:05:00", None]
    hours = apply(spark, [(t,) for t in times], trains.hour_of)
    assert hours == [22, 6, 7, 25, None, 9, None]
    night = apply(spark, [(t, "TGV") for t in times], lambda t, b: trains.is_night(trains.hour_of(t), b))
    assert night == [True, True, False, True, False, False, False]
    assert apply(spark, [(None, "Nightjet")], lambda t, b: trains.is_night(trains.hour_of(t), b)) == [True]


def test_final_type(spark):
    got = apply(
        spark, [("ICE", True), ("Nightjet", True), ("TGV", False)], trains.final_type,
        ["string", "boolean"],
    )
    assert got == ["ICE Nuit", "Nightjet", "TGV"]


def test_day_or_night_and_mode(spark):
    types = [("TGV Nuit",), ("EuroNight",), ("TGV",), ("Avion",)]
    assert apply(spark, types, trains.day_or_night) == ["Nuit", "Nuit", "Jour", None]
    assert apply(spark, types, trains.mode_of) == ["Train", "Train", "Train", "Avion"]


def test_prefix_strip_and_tokens(spark):
    got = apply(spark, [("GARE DE LYON",), ("GARE DU NORD",), ("LYON",)], text.strip_name_prefix)
    assert got == ["LYON", "NORD", "LYON"]
    assert apply(spark, [("LYON PART DIEU",), ("",)], text.token_prefixes) == [
        ["LYON PART DIEU", "LYON PART", "LYON"], [],
    ]


def test_numeric_names(spark):
    assert apply(spark, [("12345",), ("Gare 5",)], text.is_numeric_name) == [True, False]


def test_file_safe(spark):
    name = 'SNCF: Voyageurs / "Grandes Lignes" <test>|?*' + "x" * 40
    import re

    want = re.sub(r'[\\/*?:"<>|]', "", name).replace(" ", "_").strip()[:40]
    assert apply(spark, [(name,)], text.file_safe) == [want]


def test_contains_ignore_case(spark):
    got = apply(spark, [("Lyon Part-Dieu",), ("LYON",), ("Paris",), (None,)],
                lambda c: text.contains_ignore_case(c, "lyon"))
    assert got == [True, True, False, None]
    assert apply(spark, [("100%",), ("1000",)], lambda c: text.contains_ignore_case(c, "0%", literal=True)) == [True, False]


def test_station_without_country_uses_default(spark):
    assert apply(spark, [(64.1, -21.9)], carbon.electricity_factor, "double") == [0.40]


def test_vehicle_factor(spark):
    assert apply(spark, [("TGV",), ("TGV Nuit",), (None,)], carbon.vehicle_factor) == [0.29, 0.9, 0.9]


def test_golden_vectors_stay_in_the_jvm(spark):
    df = spark.range(3).select(carbon.co2_kg(F.lit(100.0), F.lit("TGV"), F.lit(48.0), F.lit(2.0)))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan
