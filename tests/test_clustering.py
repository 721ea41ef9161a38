import os
import random
import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute_force
from trendloom import schemas
from trendloom.functions import packed
from trendloom.functions.edit import distance, exceeds
from trendloom.functions.text import levenshtein_similarity
from trendloom.operators import clustering, similarity as sim
from trendloom.operators.scratch import Scratch
from trendloom.plans import jobs
from trendloom.sources.store import TableStore

SCHEMA = "title_id long, title string, summary string, published_at timestamp"
START = datetime(2026, 6, 22, 10, 0)

# The first three titles, whose word overlaps are 0.2 and 0.18.
MOCK = [
    (1001, "RBI keeps repo rate unchanged in latest policy meet",
     "No change to the repo rate was voted at this month's meeting.",
     START),
    (1002, "RBI holding repo rate steady amid macro stability concerns",
     "The repo rate stays where it was, the committee said.",
     START + timedelta(minutes=15)),
    (1003, "Central bank keeps key repo rate steady to manage inflation pressures",
     "Lenders expect the same rate through the autumn.", START + timedelta(minutes=90)),
    (1004, "Harbour town reopens its old lighthouse to visitors",
     "Guided tours climb the restored tower every weekend.",
     START + timedelta(hours=2)),
]


def as_dicts(rows):
    return [dict(zip(("title_id", "title", "summary", "published_at"), r)) for r in rows]


def run(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, SCHEMA)
    found = clustering.cluster_articles(df, **kwargs)
    return {r.title_id: r.anchor_id for r in found.collect()}


def random_articles(seed, n, shuffled=False, copies=0.0, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k:02d}" for k in range(words)]
    rows = []
    for i in range(n):
        topic = rng.randrange(6)
        pool = vocabulary[topic * 8: topic * 8 + 16]
        title = " ".join(rng.choices(pool, k=4))
        summary = " ".join(rng.choices(pool, k=8)) if rng.random() < 0.9 else None
        if rows and rng.random() < copies:
            _, title, summary, _ = rows[0] if rng.random() < 0.6 else rng.choice(rows)
        hours = rng.randrange(n * 4) if shuffled else i * 4
        rows.append((i * 3 + 1, title, summary, START + timedelta(hours=hours)))
    return rows


def test_mock_articles(spark):
    assert run(spark, MOCK) == brute_force.cluster(as_dicts(MOCK))


@pytest.mark.parametrize(
    "seed,shuffled,copies,block_rows,min_lev",
    [
        (1, False, 0.0, 2048, 0.0),
        (2, False, 0.0, 7, 0.0),
        (3, True, 0.0, 9, 0.0),
        (4, False, 0.7, 8, 0.0),
        (5, True, 0.7, 11, 0.0),
        (6, True, 0.5, 10, 0.45),
    ],
)
def test_equals_sequential_rule(spark, seed, shuffled, copies, block_rows, min_lev):
    rows = random_articles(seed, 90, shuffled, copies)
    expected = brute_force.cluster(as_dicts(rows), min_levenshtein=min_lev)
    assert run(spark, rows, block_rows=block_rows, min_levenshtein=min_lev) == expected


def test_exact_gap_is_inside(spark):
    rows = [
        (1, "alpha beta gamma", "", START),
        (2, "alpha beta gamma delta", "", START + timedelta(hours=72)),
        (3, "alpha beta gamma delta", "", START + timedelta(hours=72, seconds=1)),
    ]
    assert run(spark, rows) == {1: 1, 2: 1, 3: 3} == brute_force.cluster(as_dicts(rows))


def test_counts_in_one_proportion_are_copies(spark):
    rows = [
        (1, "alpha beta one two", "alpha beta one two", START),
        (2, "gamma delta", "", START + timedelta(hours=1)),
        (3, "alpha beta one two", "", START + timedelta(hours=73)),
        (4, "alpha beta one two", "", START + timedelta(hours=72)),
        (5, "alpha beta one two two", "", START + timedelta(hours=72)),
    ]
    found = run(spark, rows)
    assert found == brute_force.cluster(as_dicts(rows)) and found[4] == 1 and found[3] == 3


def test_articles_without_terms_stay_alone(spark):
    rows = [(1, "the and", "", START), (2, "the and", None, START), (3, "a", "", START)]
    assert run(spark, rows) == {1: 1, 2: 2, 3: 3}


def test_edit_distance_equals_plain_version():
    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choices("abcé ", k=rng.randrange(9)))
        b = "".join(rng.choices("abcé ", k=rng.randrange(9)))
        assert distance(a, b) == brute_force.edit_distance(a, b)
        for limit in (0.0, 0.3, 0.8):
            assert exceeds(a, b, limit) == (brute_force.title_similarity(a, b) > limit)


def test_report_and_averages(spark):
    df = spark.createDataFrame(MOCK, SCHEMA)
    members = spark.createDataFrame([(1001, 1001), (1002, 1001), (1003, 1001), (1004, 1004)], "title_id long, anchor_id long")
    measured = clustering.measure_members(df, members).cache()
    values = {r.title_id: r for r in measured.collect()}
    assert values[1002].jaccard_similarity == 0.2
    assert values[1003].jaccard_similarity == 0.18
    assert values[1001].levenshtein_similarity == 1.0
    averages = {r.anchor_id: r for r in clustering.cluster_averages(measured).collect()}
    assert averages[1001].volume == 3.0
    assert averages[1001].avg_jaccard == 0.46
    assert averages[1001].latest_update_time == START + timedelta(minutes=90)
    report = clustering.cluster_report(measured).filter("cluster_anchor_db_id = 1001").collect()
    assert [m.db_serial_number for r in sorted(report, key=lambda r: r.part) for m in r.metrics_payload] == [1001, 1002, 1003]
    assert report[0].volume_count == 3 and report[0].latest_update_time == "2026-06-22 11:30:00"


def test_report_parts_are_bounded(spark):
    members = spark.range(1, 3000).select(F.col("id").alias("title_id"), F.lit(1).cast("long").alias("anchor_id"))
    df = members.select("title_id", F.lit("same title").alias("title"), F.lit("").alias("summary"),
                        F.lit(START).cast("timestamp").alias("published_at"))
    report = clustering.cluster_report(clustering.measure_members(df, members)).collect()
    assert max(len(r.metrics_payload) for r in report) <= 1024
    assert sum(len(r.metrics_payload) for r in report) == 2999
    assert {r.volume_count for r in report} == {2999}


def test_pairs_are_compared_in_blocks_not_joined_by_term(spark):
    rows = random_articles(7, 60, shuffled=True, copies=0.3)
    df = spark.createDataFrame(rows, SCHEMA)
    found = sim.earlier_matches(df, block_rows=9)
    # a join on terms makes one row per pair and shared term
    assert not re.search(r"Join \w+, .*\bterm#", found._jdf.queryExecution().optimizedPlan().toString())
    vec = brute_force.vectors(as_dicts(rows))
    near = {
        (i, j): brute_force.cosine(vec[i], vec[j]) for i in range(60) for j in range(i)
        if abs((rows[i][3] - rows[j][3]).total_seconds()) <= 72 * 3600 and brute_force.cosine(vec[i], vec[j]) > 0.15
    }
    expected = {}
    for i in {i for i, _ in near}:
        mine = {j: c for (k, j), c in near.items() if k == i}
        best = max(mine.values())
        expected[rows[i][0]] = (len(mine), best, rows[min(j for j, c in mine.items() if c == best)][0])
    assert {r.title_id: (r.matches, r.best_cosine, r.best_id) for r in found.collect()} == expected


def test_pairs_of_different_blocks_once(spark):
    rows = random_articles(8, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    blocked = sim.stored_blocks(df, ("the",), 72 * 3600, 7)
    block = {r.title_id: r.block for r in blocked.collect()}
    found = [(r.title_id, r.match_id) for r in sim.cosine_pairs(blocked, 72 * 3600).collect()]
    vec = brute_force.vectors(as_dicts(rows))
    expected = {
        (rows[i][0], rows[j][0]) for i in range(60) for j in range(i)
        if block[rows[i][0]] != block[rows[j][0]] and (rows[i][3] - rows[j][3]).total_seconds() <= 144 * 3600
        and brute_force.cosine(vec[i], vec[j]) > 0.15
    }
    assert len(found) == len(expected) and set(found) == expected


def test_measuring_is_dealt_out_and_equals_the_built_in_distance(spark):
    rng = random.Random(9)
    titles = [None, "", "é"] + ["".join(rng.choices("abé ", k=rng.randrange(40))) for _ in range(60)]
    rows = [(i, t, "", START) for i, t in enumerate(titles)]
    members = spark.createDataFrame([(i, i % 5) for i in range(len(rows))], "title_id long, anchor_id long").coalesce(1)
    measured = clustering.measure_members(spark.createDataFrame(rows, SCHEMA), members)
    steps = measured._jdf.queryExecution().sparkPlan().toString().splitlines()
    found = [next((i for i, line in enumerate(steps) if name in line), -1) for name in ("ArrowEvalPython", "REPARTITION_BY_NUM", "Join")]
    assert 0 <= found[0] < found[1] < found[2]  # joined, dealt out, and only then compared
    expected = measured.select("title_id", F.round(levenshtein_similarity("main_title", "headline_text"), 2))
    assert {(r.title_id, r.levenshtein_similarity) for r in measured.collect()} == {tuple(r) for r in expected.collect()}


def test_repeated_rows_match_as_often_as_they_are_given(spark):
    rows = [(1, "alpha beta", "", START), (2, "alpha beta", "", START), (2, "alpha beta", "", START)]
    found = sim.earlier_matches(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.title_id, r.matches, r.best_id) for r in found] == [(2, 2, 1)]


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_rounds_read_lists_of_pairs_and_no_terms(spark, block_rows):
    rows = random_articles(10, 60, copies=0.3)
    gap, place = 72 * 3600, {r[0]: i for i, r in enumerate(rows)}
    blocked = sim.stored_blocks(spark.createDataFrame(rows, SCHEMA), ("the",), gap, block_rows)
    stored = sim.block_neighbours(blocked, gap).toPandas()
    assert not {"terms", "weights"} & set(stored.columns) and len(stored) == 60
    vec = brute_force.vectors(as_dicts(rows))
    for _, block in stored.groupby("block"):
        block = block.sort_values("place", ignore_index=True)
        at = [place[i] for i in block["title_id"]]
        assert at == sorted(at) and block["place"].tolist() == list(range(len(at)))
        for i, (near, cosines) in enumerate(zip(block["near"], block["cosines"])):
            expected = {
                j: brute_force.cosine(vec[at[i]], vec[at[j]]) for j in range(i)
                if abs(rows[at[i]][3] - rows[at[j]][3]) <= timedelta(hours=144)
            }
            assert dict(zip(near, cosines)) == {j: c for j, c in expected.items() if c > 0.15}
    if block_rows > 60:  # the rule needs the lists only, in whatever order the rows come
        alone = stored.sample(frac=1, random_state=1).assign(cosine=0.0, label_id=-1, label_t=0, label_title=None)
        found = clustering._block_rule(gap, 0.15, 0.0)(alone)
        assert dict(zip(found["title_id"], found["label_id"])) == brute_force.cluster(as_dicts(rows))


def test_numbers_are_packed_and_read_back():
    rng = random.Random(11)
    lengths = [rng.randrange(1, 30) for _ in range(40)]
    terms = [t for n in lengths for t in sorted(rng.sample(range(10**12), n))]
    counts = [rng.choice([1, 1, 2, 70_000]) for _ in terms]
    given = [np.array(x) for x in (lengths, terms, counts)]
    assert all((a == b).all() for a, b in zip(packed.unpack(packed.pack(*given)), given))
    vectors, sigs = packed.pack_vectors(*given, np.arange(len(terms)) + 1, 10**9)
    found = packed.unpack_vectors(vectors)
    assert (found[0] == given[0]).all() and (found[1] == given[1]).all() and len(set(sigs)) == 40
    assert np.allclose(np.add.reduceat(found[2] ** 2, np.cumsum(lengths) - lengths), 1)
    assert [len(x) for x in (*packed.unpack([]), *packed.unpack_vectors([]))] == [0] * 6


@pytest.mark.parametrize("chunk_terms", [1, 40, 1 << 21])
def test_packed_vectors_equal_the_plain_ones(spark, monkeypatch, chunk_terms):
    monkeypatch.setattr(sim, "CHUNK_TERMS", chunk_terms)
    rows = random_articles(12, 50, copies=0.3)
    rows += [rows[3], rows[3], (rows[4][0], "w01 w02 the", "w01", START), (7000, "the a", None, START), (7001, None, "Ünï 数字 x", None)]
    rows += [(None, "w01 w03", "", START), (None, "w01 only", "w05", START)]
    df = spark.createDataFrame(rows, SCHEMA)
    with Scratch(spark) as scratch:
        found = sim.article_vectors(df, scratch).toPandas()
    assert not {"terms", "weights"} & set(found.columns)  # lists of strings would fill the disk
    lengths, numbers, weights = packed.unpack_vectors(found["vector"].tolist())
    cuts = np.cumsum(lengths)[:-1]
    expected = {r.title_id: r for r in sim.tfidf_vectors(df).collect()}
    assert sorted(found["title_id"]) == sorted(r[0] for r in rows if r[0] and r[0] != 7000)
    term_of, sig_of = {}, {}
    for title_id, sig, of, w in zip(found["title_id"], found["sig"], np.split(numbers, cuts), np.split(weights, cuts)):
        plain = dict(zip(expected[title_id].terms, expected[title_id].weights))
        assert sorted(w) == pytest.approx(sorted(plain.values()), abs=1e-12) and list(of) == sorted(set(of))
        sig_of.setdefault(sig, set()).add(expected[title_id].sig)
        for number in of:  # a number stands for one term
            term_of[number] = term_of.get(number, set(plain)) & set(plain)
    assert all(len(plain) == 1 for plain in sig_of.values()) and len(sig_of) == len({r.sig for r in expected.values() if r.title_id})
    assert all(term_of.values())


def test_compared_blocks_hold_packed_vectors_only(spark, tmp_path):
    rows = random_articles(13, 60, copies=0.3)
    blocked = sim.stored_blocks(spark.createDataFrame(rows, SCHEMA), ("the",), 72 * 3600, 7)
    assert dict(blocked.dtypes)["vector"] == "binary" and not any("array" in kind for _, kind in blocked.dtypes)
    assert not [x for x in os.listdir(checkpoint_folder(spark)) if x.startswith("scratch-")]
    assert spark.conf.get(RELEASE) == "false"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_folder(spark):
    return spark.sparkContext.getCheckpointDir().removeprefix("file:")


def test_best_topic_moves_no_terms_and_skips_articles_without_a_topic(spark):
    rows = random_articles(14, 60, shuffled=True, copies=0.3)
    big = 2**60  # more than a double can tell apart
    rows = [(big + r[0], *r[1:]) for r in rows]
    anchor_of = {i: rows[i % 5] for i in range(60) if i % 4}
    assigned = spark.createDataFrame([(rows[i][0], a[0]) for i, a in anchor_of.items()], "title_id long, anchor_id long")
    found = sim.best_topic(spark.createDataFrame(rows, SCHEMA), assigned, block_rows=9)
    assert "terms#" not in found._jdf.queryExecution().optimizedPlan().toString()
    vec, expected = brute_force.vectors(as_dicts(rows)), {}
    for i, row in enumerate(rows):
        offers = [
            (-brute_force.cosine(vec[i], vec[j]), a[0]) for j, a in anchor_of.items()
            if j < i and abs(row[3] - a[3]) <= timedelta(hours=72) and abs(row[3] - rows[j][3]) <= timedelta(hours=144)
        ]
        if offers and -min(offers)[0] > 0.15:
            expected[row[0]] = (-min(offers)[0], min(offers)[1])
    assert expected and {r.title_id: (r.cosine, r.anchor_id) for r in found.collect()} == expected


def test_rounds_hold_few_tables_and_leave_none(spark, monkeypatch):
    live, most, written = set(), [], []

    class Counted(Scratch):
        def keep(self, rows):
            kept = super().keep(rows)
            live.add(id(kept))
            written.append(kept)
            most.append(len(live))
            return kept

        def drop(self, *tables):
            super().drop(*tables)
            live.difference_update(map(id, tables))

    monkeypatch.setattr(clustering, "Scratch", Counted)
    rows = random_articles(15, 60, copies=0.3)
    assert run(spark, rows, block_rows=3) == brute_force.cluster(as_dicts(rows))
    assert len(written) > 25 and max(most) <= 12  # many rounds, whose tables go
    assert not any({"label_title", "terms"} & set(table.columns) for table in written[3:])  # titles are looked up
    assert not [x for x in os.listdir(checkpoint_folder(spark)) if x.startswith("scratch-")]


def test_clustering_a_store_leaves_no_copy_of_its_texts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    marker = "quartzmarker"
    rows = [(i, "s", f"{marker} alpha {i}", None, f"{marker} beta", START + timedelta(hours=i)) for i in range(1, 9)]
    kinds = {f.name: f.dataType for f in schemas.ARTICLE_ROWS.fields}
    names = ("title_id", "source_id", "title", "link", "summary", "date_captured")
    articles = spark.createDataFrame(rows, "title_id long, source_id string, title string, link string, summary string, date_captured timestamp")
    store.write(jobs.ARTICLES, articles.select(*[F.col(n).cast(kinds[n]) for n in names]), "a")
    folder, before = checkpoint_folder(spark), set()
    for at, _, files in os.walk(folder):
        before.update(os.path.join(at, f) for f in files)
    assert jobs.cluster_open_articles(store, run="r") == 1
    left = [os.path.join(at, f) for at, _, files in os.walk(folder) for f in files]
    texts = [f for f in left if f not in before and open(f, "rb").read().count(b"beta")]
    assert texts == [] and not [x for x in os.listdir(folder) if x.startswith("scratch-")]
    assert spark.conf.get(RELEASE) == "false"
    assert all(f.endswith(".zstd.parquet") or f.endswith(".zst.parquet") or "zstd" in f for _, _, files in os.walk(tmp_path / "store") for f in files if f.endswith(".parquet"))
