"""Schemas of the input tables, given to the readers so that none is inferred."""

RAW_WEATHER = "date DATE, temp_max DOUBLE, temp_min DOUBLE, precipitation DOUBLE, city STRING"

HISTORY = (
    "date DATE, temp_min DOUBLE, temp_max DOUBLE, "
    "soil_temp_0_7cm DOUBLE, soil_temp_7_to_28cm DOUBLE, city STRING"
)

SUN_TIMES = (
    "date STRING, morning_twilight STRING, sunrise STRING, solar_noon STRING, "
    "sunset STRING, evening_twilight STRING, day_length STRING, city STRING"
)

PLANTS = (
    "common_name STRING, plant_family STRING, growing_season STRING, harvest_type STRING, "
    "weeks_indoor_before_transplant INT, days_to_maturity INT, "
    "min_viable_temp_f DOUBLE, max_viable_temp_f DOUBLE, "
    "ideal_temp_min_f DOUBLE, ideal_temp_max_f DOUBLE, square_feet_needed DOUBLE, "
    "direct_sow BOOLEAN, attracts_bees BOOLEAN, attracts_butterflies BOOLEAN, attracts_hummingbirds BOOLEAN"
)
