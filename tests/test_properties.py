"""Random documents through silver and gold, against the same result worked out row by row in Python."""

import math
import random
import re
from collections import Counter

import pytest

from tasteforge import schemas
from tasteforge.plans.gold import interaction_matrix, score_interactions
from tasteforge.plans.silver import silver_interactions, silver_reviews

STAMPS = [None, "2026-06-08T00:00:00", "2026-06-08T00:00:00.5", "2026-06-09T00:00:00"]
WORDS = ["good", "bad", "\n", "\r\n", " ", "\t", " ", "\U0001f600", "game", ""]


def random_documents(rng):
    """A third of all documents belong to one user and one app."""

    def pick(n, hot):
        return hot if rng.random() < 1 / 3 else str(rng.randrange(n))

    profiles, reviews = [], []
    for n in range(120):
        games = [(rng.randrange(12), rng.choice([None, 0, 1, 50, 172139])) for _ in range(rng.randrange(5))]
        games = list({appid: (appid, minutes) for appid, minutes in games}.values())
        profiles.append((rng.choice(STAMPS), pick(20, "hot"), len(games), rng.choice([games, games, None]), f"f{n:04d}"))
    for n in range(60):
        entries = [
            (f"r{n}-{i}", pick(20, "hot"), 1, rng.choice([True, False, None]), 0, 0.5, True,
             rng.choice([None, "".join(rng.choice(WORDS) for _ in range(rng.randrange(9)))]))
            for i in range(rng.randrange(4))
        ]
        reviews.append((rng.choice(STAMPS), pick(12, "3"), len(entries), entries, f"f{n:04d}"))
    return profiles, reviews


def latest(documents):
    best = {}
    for doc in documents:
        order = (doc[0] is not None, doc[0] or "", doc[4])
        if doc[1] not in best or order > best[doc[1]][0]:
            best[doc[1]] = (order, doc)
    return [doc for _, doc in best.values()]


def expected_silver(profiles, reviews):
    played = [(d[1], str(a), m) for d in latest(profiles) for a, m in d[3] or [] if m is not None and m > 0]
    kept = []
    for doc in latest(reviews):
        for review_id, user, minutes, up, _, score, _, text in doc[3]:
            text = None if text is None else re.sub(r"[\r\n]+", " ", text).strip(" ")
            if text is not None and len(text) >= 10:
                kept.append((doc[1], review_id, user, minutes, up, score, text))
    return played, kept


def expected_matrix(played, kept):
    votes = {}
    for app, _, user, _, up, _, _ in kept:
        votes.setdefault((user, app), []).append(up)
    scored = []
    for user, app, minutes in played:
        for up in votes.get((user, app), [None]):
            scored.append((user, app, math.log1p(minutes) * {True: 1.5, False: 0.5, None: 1.0}[up]))

    def number(ids):
        return {k: i for i, (k, _) in enumerate(sorted(Counter(ids).items(), key=lambda e: (-e[1], e[0])))}

    users, items = number(s[0] for s in scored), number(s[1] for s in scored)
    return sorted((users[u], items[a], round(score, 4)) for u, a, score in scored)


@pytest.mark.parametrize("seed", range(4))
def test_silver_and_gold_equal_the_row_by_row_result(spark, seed):
    profiles, reviews = random_documents(random.Random(seed))
    raw_users = spark.createDataFrame(profiles, f"{schemas.USER_PROFILES}, source_file STRING").repartition(1 + seed)
    raw_reviews = spark.createDataFrame(reviews, f"{schemas.APP_REVIEWS}, source_file STRING").repartition(1 + seed)
    interactions = silver_interactions(raw_users, ["source_file"])
    texts = silver_reviews(raw_reviews, ["source_file"])
    played, kept = expected_silver(profiles, reviews)
    assert sorted(map(tuple, interactions.collect())) == sorted(played)
    columns = ["app_id", "review_id", "steam_id", "playtime_minutes", "voted_up", "weighted_score", "review_text"]
    assert texts.columns == columns
    assert sorted(map(tuple, texts.collect()), key=str) == sorted(kept, key=str)

    for broadcast_rows in (100_000, 2):
        tables = interaction_matrix(score_interactions(interactions, texts), broadcast_rows=broadcast_rows)
        got = sorted((r.user_index, r.item_index, round(r.interaction_score, 4)) for r in tables.matrix.collect())
        assert got == expected_matrix(played, kept)
