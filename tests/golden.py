"""Invented readings of 37 days in two cities, and results computed from them by hand
and with an SQL engine.

Readings follow a rule, but for a few that make cases: a mean that ends in 5 at the
second decimal, a week of exactly one inch, a half-degree high, and (by the dates) a
first week of which only a part lies in the last 30 days.
"""

FIRST_DAY = "2027-03-04"
AS_OF = "2027-04-03"
CITIES = ("Alder", "Birch")


def _readings(city: int) -> tuple[list[float], list[float], list[float]]:
    days = range(37)
    highs = [(460 + 25 * city + (37 * d + 11 * city) % 97 + 3 * d) / 10 for d in days]
    lows = [(250 + 60 * city + (53 * d + 29 * city) % 113 + 2 * d) / 10 for d in days]
    rain = [(71 * d + 130 * city) % 400 / 1000 if (5 * d + city) % 3 == 0 else 0.0 for d in days]
    if city == 0:
        highs[5], lows[5] = 41.2, 29.9
        highs[31] = 58.5
        rain[25:32] = [0.3, 0.0, 0.1, 0.25, 0.05, 0.2, 0.1]
    return highs, lows, rain


HIGHS, LOWS, RAIN = ({c: _readings(n)[k] for n, c in enumerate(CITIES)} for k in range(3))

NO, LIGHT, YES = "No irrigation needed", "Light irrigation needed", "Irrigation needed"

TRACKER = [
    ("Alder", "2027-03-01", 0.213, -0.787, YES),
    ("Alder", "2027-03-08", 0.265, -0.735, YES),
    ("Alder", "2027-03-15", 0.317, -0.683, YES),
    ("Alder", "2027-03-22", 0.473, -0.527, YES),
    ("Alder", "2027-03-29", 1.0, 0.0, NO),
    ("Alder", "2027-04-05", 0.499, -0.501, YES),
    ("Birch", "2027-03-01", 0.201, -0.799, YES),
    ("Birch", "2027-03-08", 0.281, -0.719, YES),
    ("Birch", "2027-03-15", 0.319, -0.681, YES),
    ("Birch", "2027-03-22", 0.371, -0.629, YES),
    ("Birch", "2027-03-29", 0.754, -0.246, LIGHT),
    ("Birch", "2027-04-05", 0.144, -0.856, YES),
]

RECENT_WEEKS = [
    ("Alder", "2027-03-01", 49.6, 30.4, 0.21, "Unknown"),
    ("Alder", "2027-03-08", 51.1, 32.8, 0.265, YES),
    ("Alder", "2027-03-15", 54.9, 32.6, 0.317, YES),
    ("Alder", "2027-03-22", 56.6, 35.6, 0.473, YES),
    ("Alder", "2027-03-29", 58.9, 35.6, 1.0, NO),
    ("Birch", "2027-03-01", 53.2, 36.5, 0.2, "Unknown"),
    ("Birch", "2027-03-08", 55.4, 36.9, 0.281, YES),
    ("Birch", "2027-03-15", 57.1, 39.9, 0.319, YES),
    ("Birch", "2027-03-22", 60.2, 39.6, 0.371, YES),
    ("Birch", "2027-03-29", 60.6, 44.5, 0.754, LIGHT),
]

ALDER_FORECAST = [
    ("2027-04-03", 59.0, 32.0, 0.2),
    ("2027-04-04", 58.0, 37.0, 0.1),
    ("2027-04-05", 58.0, 32.0, 0.0),
    ("2027-04-06", 62.0, 37.0, 0.34),
    ("2027-04-07", 66.0, 42.0, 0.0),
    ("2027-04-08", 60.0, 37.0, 0.0),
    ("2027-04-09", 64.0, 42.0, 0.16),
]

# (low bound, high bound) of a plant's band -> viable days of the next 7
VIABLE_DAYS = {
    "Alder": {(45, 55): 0, (50, 60): 4, (55, 85): 7},
    "Birch": {(45, 55): 0, (50, 60): 1, (55, 85): 7},
}
