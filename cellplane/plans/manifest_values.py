"""What the manifest says of each band beyond what follows from its name and its sources."""

# Label, family and stage of a band, in file order.
BANDS = (
    ("official_settlement_source", "Amtliches Wohnbauland", "siedlung", "quelle"),
    ("settlement_buffer", "Siedlungsabstand", "siedlung", "zone"),
    ("haeuser_im_gruenen_ferienhaus", "Ferienhaus und Tourismus", "haeuser_im_gruenen", "quelle"),
    ("haeuser_im_gruenen_widmung", "Amtliche Einzellagen-Widmung", "haeuser_im_gruenen", "quelle"),
    ("haeuser_im_gruenen_streusiedlung", "Streusiedlungs-Hüllen", "haeuser_im_gruenen", "quelle"),
    ("haeuser_im_gruenen_noe_pdf", "NÖ-Mindestabstandszonen", "haeuser_im_gruenen", "quelle"),
    ("haeuser_im_gruenen", "Häuser im Grünen", "haeuser_im_gruenen", "zone"),
    ("nonresidential_hulls_source", "Nicht-Wohn-Hüllen", "nichtwohn_huellen", "quelle"),
    ("nonresidential_hulls_buffer", "Ausschluss Nicht-Wohn-Hüllen", "nichtwohn_huellen", "zone"),
    ("cableway_buildings_source", "Seilbahn-Gebäude", "seilbahn_gebaeude", "quelle"),
    ("cableway_buildings_buffer", "Ausschluss Seilbahn-Gebäude", "seilbahn_gebaeude", "zone"),
    ("general_buildings_source", "Sonstige Gebäude und Einzellagen", "gebaeude", "quelle"),
    ("general_buildings_buffer", "Ausschluss sonstige Gebäude", "gebaeude", "zone"),
    ("road_motorway_trunk", "Autobahnen und Schnellstraßen", "verkehr", "zone"),
    ("road_federal_state", "Bundes- und Landesstraßen", "verkehr", "zone"),
    ("rail_main", "Hauptbahnen", "verkehr", "zone"),
    ("cableway_people_150m", "Personenseilbahnen", "verkehr", "zone"),
    ("military_restricted_area", "Militärisches Sperrgebiet", "militaer", "zone"),
    ("airport_area_major", "Hauptflughafen-Areale", "luftfahrt", "zone"),
    ("airport_runway_corridor_5km", "An- und Abflugkorridore", "luftfahrt", "zone"),
    ("nature_protection_areas", "Amtliche Schutzgebiete", "schutzgebiet", "zone"),
    ("osm_nature_protection_areas", "Schutzgebiete aus OpenStreetMap", "schutzgebiet", "zone"),
    ("geography_slope_too_steep", "Hangneigung zu steil", "kriterien", "zone"),
    ("geography_elevation_too_high", "Seehöhe zu hoch", "kriterien", "zone"),
    ("geography_wind_too_low", "Wind zu gering", "kriterien", "zone"),
    ("geography_water_bodies", "Größere Gewässer", "kriterien", "zone"),
    ("exclusion_human", "Ausschluss Mensch", "summe", "summe_zonen"),
    ("exclusion_nature", "Ausschluss Natur", "summe", "summe_zonen"),
    ("exclusion_geography", "Ausschluss Geografie", "summe", "summe_zonen"),
    ("all_exclusions", "Ausschluss gesamt", "ergebnis", "summe_zonen"),
    ("available_after_all_exclusions_raw", "Verfügbare Fläche roh", "ergebnis", "ergebnis"),
    ("official_wind_zoning", "Amtliche Windkraft-Zonen", "amtliche_zonen", "zone"),
    ("wka_bestand_ausserhalb_zonen", "WKA-Bestand außerhalb der Zonen", "wka_bestand", "zone"),
    ("haeuser_im_gruenen_source", "Quellen Häuser im Grünen", "haeuser_im_gruenen", "aggregat"),
    ("general_buildings_roh_osm", "Sonstige Gebäude aus OpenStreetMap", "gebaeude", "roh"),
    ("general_buildings_roh_dkm", "Sonstige Gebäude aus dem Kataster", "gebaeude", "roh"),
    ("sources_human", "Quellen Mensch", "summe", "summe_quellen"),
    ("sources_nature", "Quellen Natur", "summe", "summe_quellen"),
    ("sources_geography", "Quellen Geografie", "summe", "summe_quellen"),
)
# Results by the start of the name, the words for the strength of a blur, the order of the stages.
CLEANED, CLEANED_LABEL = "available_cleaned_min_", "Eignungsflächen"
BLUR, BLUR_LABEL = "available_blur_sigma_", "Unschärfe"
STRENGTH = {"100m": "schwach", "200m": "mittel", "250m": "stark", "300m": "sehr stark"}
STAGES = ("roh", "quelle", "aggregat", "zone", "summe_quellen", "summe_zonen", "ergebnis")
# Bands that a panel shows, and those of them that it shows at once.
PANEL = (
    "settlement_buffer", "haeuser_im_gruenen", "nonresidential_hulls_buffer", "cableway_buildings_buffer", "general_buildings_buffer", "road_motorway_trunk",
    "road_federal_state", "rail_main", "cableway_people_150m", "military_restricted_area", "airport_area_major", "airport_runway_corridor_5km",
    "geography_slope_too_steep", "geography_elevation_too_high", "geography_wind_too_low", "geography_water_bodies", "exclusion_human", "exclusion_nature",
    "exclusion_geography", "all_exclusions", "available_cleaned_min_10ha", "official_wind_zoning", "wka_bestand_ausserhalb_zonen",
)
VISIBLE = ("exclusion_human", "exclusion_nature", "exclusion_geography", "available_cleaned_min_10ha", "official_wind_zoning")
