"""Sample messages and the results worked out from them by hand."""

# Sample inputs.
LINES = ["hello kafka streams", "all streams lead to kafka", "join kafka summit"]

WORD_COUNTS = {
    "all": 1,
    "hello": 1,
    "join": 1,
    "kafka": 3,
    "lead": 1,
    "streams": 2,
    "summit": 1,
    "to": 1,
}

# (title, time of sale, amount)
SALES = [
    ("Die Hard", "2019-07-18T10:01:00Z", 2),
    ("The Godfather", "2019-07-18T10:01:31Z", 4),
    ("Die Hard", "2019-07-18T10:01:36Z", 24),
    ("The Godfather", "2019-07-18T10:02:00Z", 18),
    ("ZZZ", "2019-07-18T11:40:09Z", 18),
    ("The Big Lebowski", "2019-07-18T11:03:21Z", 12),
    ("The Big Lebowski", "2019-07-18T11:03:50Z", 12),
    ("The Godfather", "2019-07-18T11:40:00Z", 36),
    ("The Godfather", "2019-07-18T11:40:09Z", 18),
    ("ZZZ", "2019-07-18T11:40:09Z", 18),
    ("AAA", "2019-07-18T11:40:09Z", 1),
    ("BBB", "2019-07-18T11:40:09Z", 4),
]

SALE_TOTALS = {
    "AAA": 1,
    "BBB": 4,
    "Die Hard": 26,
    "The Big Lebowski": 24,
    "The Godfather": 76,
    "ZZZ": 36,
}

# (id, title, year)
MOVIES = [
    (294, "Die Hard", 1988),
    (354, "Tree of Life", 2011),
    (782, "A Walk in the Clouds", 1995),
    (128, "The Big Lebowski", 1998),
    (780, "Super Mario Bros.", 1993),
]

# (id, rating)
RATINGS = [
    (294, 8.2),
    (294, 8.5),
    (354, 9.9),
    (354, 9.7),
    (782, 7.8),
    (782, 7.7),
    (128, 8.7),
    (128, 8.4),
    (780, 2.1),
]
