"""Known inputs and results of one real market, 19 entities.

Entities are numbered in the order of the index table.
"""

# rain, weekend and temperature components, volatility -> index, rank, behaviour
INDEX = [
    (-38.2, 14.82, 6.27, 100.0, 69.0, 1, "Moderate Dynamic"),
    (1.22, 3.76, 2.19, 58.82, 35.85, 2, "Low Dynamic"),
    (0.0, 0.0, 13.55, 38.01, 28.04, 3, "Low Dynamic"),
    (0.0, 4.71, 3.69, 4.07, 9.21, 4, "Static Pricer"),
    (1.23, 4.62, 0.85, 2.71, 7.77, 5, "Static Pricer"),
    (-24.43, -21.32, -15.79, 10.41, 5.21, 6, "Static Pricer"),
    (0.0, 0.0, -5.73, 5.43, 2.72, 7, "Static Pricer"),
    (0.0, -13.24, -13.24, 0.45, 0.23, 8, "Static Pricer"),
] + [(0.0, 0.0, 0.0, 0.0, 0.0, 9, "Static Pricer")] * 11

# change events -> volatility
EVENTS = [(221, 100.0), (130, 58.82), (84, 38.01), (9, 4.07), (6, 2.71), (23, 10.41), (12, 5.43),
          (1, 0.45)] + [(0, 0.0)] * 11

# entity: {hour: (events, mean change)}
CELLS = {
    "behrouz": {12: (2, 1.23), 14: (2, 1.23), 16: (1, 4.62), 18: (1, -4.42)},
    "box": {12: (1, 4.71), 14: (2, -4.49), 16: (1, 21.54), 18: (1, 4.71), 20: (2, 8.53),
            22: (2, -17.72)},
    "burger": {12: (18, -20.08), 14: (5, -0.33)},
    "darjeeling": {14: (84, 13.55)},
    "faasos": {12: (10, 14.19), 14: (44, 9.37), 15: (2, 9.12), 16: (1, -38.2), 18: (135, 6.23),
               20: (8, -34.46), 21: (1, -8.24), 22: (20, 9.7)},
    "kake": {16: (1, -5.73), 20: (11, 8.59)},
    "mughlai": {18: (1, -13.24)},
    "momo": {10: (2, -11.14), 11: (2, 15.52), 12: (17, 6.19), 14: (18, 4.69), 15: (2, 12.81),
             16: (28, -0.01), 17: (1, -23.33), 18: (20, -5.19), 19: (2, 25.51), 20: (18, 2.38),
             21: (2, 15.52), 22: (18, 4.69)},
}

# hour: events, mean change
OVERALL = {10: (2, -11.14), 11: (2, 15.52), 12: (48, -2.23), 13: (0, 0.0), 14: (155, 10.49),
           15: (4, 10.96), 16: (32, -0.57), 17: (1, -23.33), 18: (158, 4.58), 19: (2, 25.51),
           20: (39, -3.11), 21: (3, 7.6), 22: (40, 6.08)}

# (entity, window): events, mean change
WINDOWS = {
    ("behrouz", "2-Lunch Peak"): (2, 1.23), ("behrouz", "3-Afternoon Off-Peak"): (4, 0.67),
    ("box", "2-Lunch Peak"): (1, 4.71), ("box", "3-Afternoon Off-Peak"): (4, 4.32),
    ("box", "4-Dinner Peak"): (2, 8.53), ("box", "5-Late Night Off-Peak"): (2, -17.72),
    ("burger", "2-Lunch Peak"): (18, -20.08), ("burger", "3-Afternoon Off-Peak"): (5, -0.33),
    ("darjeeling", "3-Afternoon Off-Peak"): (84, 13.55),
    ("faasos", "2-Lunch Peak"): (10, 14.19), ("faasos", "3-Afternoon Off-Peak"): (182, 6.78),
    ("faasos", "4-Dinner Peak"): (8, -34.46), ("faasos", "5-Late Night Off-Peak"): (21, 8.85),
    ("kake", "3-Afternoon Off-Peak"): (1, -5.73), ("kake", "4-Dinner Peak"): (11, 8.59),
    ("mughlai", "3-Afternoon Off-Peak"): (1, -13.24),
    ("momo", "1-Morning Off-Peak"): (4, 2.19), ("momo", "2-Lunch Peak"): (17, 6.19),
    ("momo", "3-Afternoon Off-Peak"): (69, -0.25), ("momo", "4-Dinner Peak"): (20, 4.69),
    ("momo", "5-Late Night Off-Peak"): (20, 5.78),
}

# the hour of the highest mean change and its value, where unambiguous
PEAKS = {"behrouz": (16, 4.62), "box": (16, 21.54), "darjeeling": (14, 13.55),
         "faasos": (12, 14.19), "kake": (20, 8.59), "momo": (19, 25.51)}

# pairs with |r| >= 0.4
PAIRS = {
    ("faasos", "kake"): 1.0, ("kake", "momo"): 1.0, ("behrouz", "momo"): 0.5624,
    ("behrouz", "box"): 0.5029, ("box", "momo"): -0.4217, ("behrouz", "faasos"): -0.6205,
    ("box", "faasos"): -0.7208, ("box", "kake"): -1.0, ("box", "burger"): -1.0,
    ("burger", "momo"): -1.0, ("burger", "faasos"): -1.0,
}
