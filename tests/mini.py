"""Hand-made input: two complete feeds, a broken one, a night sheet and airports."""

from pathlib import Path

STOPS = """stop_id,stop_name,stop_lat,stop_lon
P,Paris Gare de Lyon,48.8443,2.3744
L,Lyon Part-Dieu (FR),45.7605,4.8597
M,Marseille St-Charles,43.3027,5.3804
Z,Zero,0.0,0.0
N,12345,47.0,4.0
"""
FR = {
    "stops": STOPS,
    "routes": "route_id,route_type,route_short_name,route_long_name\n"
    "R1,2,TGV,\nR2,102,,Intercites de Nuit\nR3,3,BUS,\nR4,abc,X,\n",
    "trips": "trip_id,route_id,shape_id\nT1,R1,s\nT2,R2,s\nT3,R3,s\nT4,R4,s\n",
    "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"
    "T1,09:00:00,09:00:00,P,1\nT1,11:00:00,11:05:00,L,2\nT1,13:00:00,13:00:00,M,3\n"
    "T2,22:30:00,22:30:00,P,1\nT2,23:00:00,23:00:00,Z,2\nT2,24:00:00,24:00:00,N,3\nT2,30:10:00,30:10:00,M,4\n"
    "T3,08:00:00,08:00:00,P,1\nT3,10:00:00,10:00:00,L,2\n"
    "T4,08:00:00,08:00:00,P,1\nT4,10:00:00,10:00:00,L,2\n",
}
DE = {
    # another column order, a BOM and no route_long_name
    "stops": "﻿stop_lat,stop_lon,stop_id,stop_name\n47.5474,7.5896,B,Basel SBB\n"
    "50.1071,8.6632,F,Frankfurt(Main)Hbf\n50.9430,6.9589,K,Köln Hbf\n",
    "routes": "route_id,route_type,route_short_name\nR1,101,ICE\n",
    "trips": "route_id,trip_id\nR1,T1\n",
    "stop_times": "trip_id,stop_id,stop_sequence,departure_time,arrival_time\n"
    "T1,B,1,06:30:00,06:30:00\nT1,F,2,09:20:00,09:15:00\nT1,K,3,10:25:00,10:25:00\n",
}
AIRPORTS = """id,ident,type,name,latitude_deg,longitude_deg,iso_country,iata_code
1,LFPG,large_airport,Charles de Gaulle,49.0128,2.55,FR,CDG
2,LFPO,large_airport,Orly,48.7233,2.3794,FR,ORY
3,LFLL,large_airport,Lyon Saint Exupery,45.7256,5.0811,FR,LYS
4,LFML,large_airport,Marseille Provence,43.4393,5.2214,FR,MRS
5,LFSB,large_airport,Basel Mulhouse,47.59,7.5291,FR,BSL
6,EDDF,large_airport,Frankfurt,50.0333,8.5706,DE,FRA
7,EDDK,large_airport,Köln Bonn,50.8659,7.1427,DE,CGN
8,HELI,heliport,Paris Heli,48.8443,2.3744,FR,PHP
9,BAD,large_airport,No Place,x,,FR,BAD
"""
FOOTFALL = (
    "﻿Nom de la gare;Code;Total Voyageurs 2023;Total Voyageurs 2024\n"
    "Paris Gare de Lyon;1;90;100\nLyon Part Dieu;2;40;50\nLyon;3;6;7\nLyon;4;8;9\n"
)
COMMUNES = "nom,code,population\nLyon,69123,500000\nLyon,01000,10\nSaint-Étienne,42218,170000\nParis,75056,2100000\nMarseille,13055,860000\n"
GAZETTEER = (
    "name,asciiname,country_code,population,latitude,longitude\n"
    "Köln,Koeln,DE,1000000,50,6\nBasel,Basel,CH,170000,47,7\nBasel,Basel,FR,5,47,7\nFrankfurt(Main)Hbf,Frankfurt,DE,700000,50,8\n"
)
EXPECTED = {
    # origin, destination, type: km, train kg, plane kg, saved kg, substitutable
    ("Paris Gare de Lyon", "Lyon Part-Dieu", "TGV"): (390.7184, 3.1015, 118.3598, 115.2583, 1),
    ("Paris Gare de Lyon", "Marseille St-Charles", "TGV"): (658.2440, 5.2251, 167.2293, 162.0042, 0),
    ("Lyon Part-Dieu", "Marseille St-Charles", "TGV"): (276.3922, 2.1940, 102.5562, 100.3622, 1),
    ("Basel SBB", "Frankfurt(Main)Hbf", "ICE Nuit"): (295.2679, 0.2604, 113.7233, 113.4629, 1),
    ("Basel SBB", "Köln Hbf", "ICE Nuit"): (380.3350, 0.3355, 116.8978, 116.5624, 1),
    ("Frankfurt(Main)Hbf", "Köln Hbf", "ICE"): (152.1593, 8.7233, 87.9427, 79.2194, 1),
}
NEAREST = {
    "Paris Gare de Lyon": ("ORY", 13.4596), "Lyon Part-Dieu": ("LYS", 17.6136),
    "Marseille St-Charles": ("MRS", 19.8969), "Basel SBB": ("BSL", 6.5605),
    "Frankfurt(Main)Hbf": ("FRA", 10.5365), "Köln Hbf": ("CGN", 15.4792),
}


def write_feed(root: Path, feed: str, tables: dict) -> None:
    folder = root / feed
    folder.mkdir(parents=True)
    for table, content in tables.items():
        (folder / f"{table}.txt").write_text(content, encoding="utf-8")


def write_all(root: Path) -> dict[str, str]:
    gtfs = root / "gtfs"
    write_feed(gtfs, "FR_demo_1", FR)
    write_feed(gtfs, "DE_demo_2", DE)
    write_feed(gtfs, "XX_broken_3", {k: v for k, v in FR.items() if k != "routes"})
    airports = root / "airports"
    airports.mkdir()
    (airports / "airports_2026-01-01.csv").write_text("name\nold\n", encoding="utf-8")
    (airports / "airports_2026-02-01.csv").write_text(AIRPORTS, encoding="utf-8")
    lists = root / "lists"
    lists.mkdir()
    (lists / "sncf_frequentation_2026-01-01.csv").write_text(FOOTFALL, encoding="utf-8")
    (lists / "communes_population_france_2026-01-01.csv").write_text(COMMUNES, encoding="utf-8")
    (lists / "geonames_cities_2026-01-01.csv").write_text(GAZETTEER, encoding="utf-8")
    return {"gtfs": str(gtfs), "airports": str(airports), "lists": str(lists)}
