"""Plain sequential versions of the topic rule, for small inputs only."""

import math
import re
from collections import Counter
from fractions import Fraction

from trendloom.functions.text import ENGLISH_STOP_WORDS


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def title_similarity(a, b):
    longest = max(len(a), len(b))
    return 1.0 if not longest else (longest - edit_distance(a, b)) / longest


def vectors(articles, stop_words=ENGLISH_STOP_WORDS):
    counts = []
    for a in articles:
        words = re.findall(r"\w\w+", f"{a['title']} {a['summary'] or ''}".lower())
        counts.append(Counter(w for w in words if w not in stop_words))
    df = Counter(w for c in counts for w in c)
    n = len(articles)
    result = []
    for c in counts:
        raw = {w: k * (math.log((1 + n) / (1 + df[w])) + 1) for w, k in c.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        result.append(({w: v / norm for w, v in raw.items()}, c))
    return result


def cosine(u, v):
    (a, counts_a), (b, counts_b) = u, v
    if not a or not b:
        return 0.0
    if counts_a.keys() == counts_b.keys() and len({Fraction(k, counts_b[w]) for w, k in counts_a.items()}) == 1:
        return 1.0
    return min(round(sum(x * b[w] for w, x in a.items() if w in b), 6), 0.999999)


def cluster(articles, gap_hours=72, min_cosine=0.15, min_levenshtein=0.0):
    """title_id -> anchor title_id, one article after the other."""
    articles = sorted(articles, key=lambda a: a["title_id"])
    vec = vectors(articles)
    topics = []
    for i, a in enumerate(articles):
        best, found = 0.0, None
        for topic in topics:
            if abs((a["published_at"] - articles[topic[0]]["published_at"]).total_seconds()) > gap_hours * 3600:
                continue
            score = max(cosine(vec[i], vec[j]) for j in topic)
            if score > best:
                best, found = score, topic
        if found and best > min_cosine:
            first = articles[found[0]]["title"].lower()
            if title_similarity(first, a["title"].lower()) > min_levenshtein:
                found.append(i)
                continue
        topics.append([i])
    return {articles[i]["title_id"]: articles[t[0]]["title_id"] for t in topics for i in t}
