"""Exact dedup, n-gram join, mixing, neighbours and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from goldleaf.llm import block_naming, c2lsh, common, components, mixing, ngram_join
from tests.llm.test_text_operators import ODD_TEXTS, check_packing, sets_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = "doc_id bigint, text string, uid int, name string, cls string, level int"


def frame_of(spark, rows, tmp_path_factory):
    """A stored table with further columns whose names the operators use themselves."""
    path = str(tmp_path_factory.mktemp("rows") / "t")
    spark.createDataFrame([(*r, 1, "n", "c", 0) for r in rows], CLASHING).write.parquet(path)
    return spark.read.parquet(path)


# --- exact dedup -----------------------------------------------------------------------------------------

def test_block_naming_finds_equal_texts(spark, tmp_path_factory):
    long = "".join(random.Random(4).choices("abcé \n", k=1000))
    rows = list(enumerate([*ODD_TEXTS, "SAME TEXT", "ÉÉ", "éé", long, long.upper().replace("É", "é"), long[:-1],
                           long + "x", long[:64], long[:64] + long[:64], long[64:128] + long[:64]]))
    rows += [(None, "a"), (5, "zz"), (5, "ZZ"), (None, None)]
    docs = frame_of(spark, rows, tmp_path_factory)
    for size in (1, 64, 4096):
        got = block_naming.exact_duplicates(docs, block_chars=size).collect()
        groups = defaultdict(list)
        for doc_id, text in rows:
            groups[(text or "").translate(LOWER)].append(doc_id)
        least = lambda x: float("-inf") if x is None else x
        want = [(d, max(ids, key=least), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for d in ids]
        assert sets_of((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == sets_of(want)
        kept = [r for r in got if r["kept"]]
        assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert block_naming.exact_duplicates(docs.where("doc_id < 0")).collect() == []


def test_blocks_with_one_fingerprint_are_told_apart(spark, tmp_path_factory, monkeypatch):
    """With a fingerprint that says nothing every block takes the way of the shared ones."""
    monkeypatch.setattr(block_naming, "fingerprint", lambda block: F.length(block).cast("bigint") * 0)
    rows = list(enumerate(["a", "b", "A", "", None, "abc", "abd", "ABC"]))
    got = block_naming.exact_duplicates(frame_of(spark, rows, tmp_path_factory), block_chars=2).collect()
    assert {r["doc_id"]: r["keep_id"] for r in got} == {0: 2, 1: 1, 2: 2, 3: 4, 4: 4, 5: 7, 6: 6, 7: 7}


# --- n-gram join -----------------------------------------------------------------------------------------

def brute_components(rows, words, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append(set() if not w else {tuple(w)} if len(w) < words else {tuple(w[i:i + words]) for i in range(len(w) - words + 1)})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, tokens in enumerate(sets):
        shared = Counter(j for t in tokens for j in holders[t])
        for j, n in shared.items():
            if 100 * n >= percent * (len(tokens) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for t in tokens:
            holders[t].append(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[root(i)].append(doc_id)
    least = {r: min((d for d in x if d is not None), default=None) for r, x in ids.items()}
    return [(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)]


def near_copies(seed, families=6, copies=25):
    """Texts in families: chains of small edits, a passage that most texts share, exact copies."""
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "one two three"), (None, "One two THREE"), (70, "one two three")]
    for f in range(families):
        words = [f"f{f}w{i}" for i in range(rng.choice([8, 40, 120]))]
        for c in range(copies):
            if rng.random() < 0.5:
                words = list(words)
                words[rng.randrange(len(words))] = f"e{f}.{c}"
            rows.append((1000 * (f + 1) + c, " ".join(words) + (f"\n{passage}" if rng.random() < 0.6 else "")))
    return rows


@pytest.mark.parametrize("group_tokens", [500_000, 300])
def test_components_match_brute_force(spark, tmp_path_factory, monkeypatch, group_tokens):
    monkeypatch.setattr(ngram_join, "GROUP_TOKENS", group_tokens)  # small: families are split into many groups
    rows = near_copies(group_tokens)
    docs = frame_of(spark, rows, tmp_path_factory)
    for words, percent in ((4, 85), (5, 80), (2, 60)):
        got = ngram_join.similar_documents(docs, words, percent).collect()
        assert sets_of((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sets_of(
            brute_components(rows, words, percent))


def test_join_of_all_documents_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = ngram_join.similar_documents(docs, 4, 85).collect()
    assert sets_of((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sets_of(brute_components(rows, 4, 85))
    assert ngram_join.similar_documents(docs.where("doc_id < 0")).collect() == []


def test_classes_that_ask_a_group_are_split(spark, tmp_path, tmp_path_factory, monkeypatch):
    """A family that is alike but not linked: no task gets all of those that ask one of its groups."""
    bound, real, seen = 1000, ngram_join._links_with_group, str(tmp_path)

    def watched(members, queries, percent):
        import os
        import uuid
        sizes = [sum(len(t) // 8 for t in rows["tokens"]) for rows in (members, queries)]
        open(os.path.join(seen, f"{sizes[0]}-{sizes[1]}-{uuid.uuid4().hex}"), "w").close()
        return real(members, queries, percent)

    monkeypatch.setattr(ngram_join, "GROUP_TOKENS", bound)
    monkeypatch.setattr(ngram_join, "_links_with_group", watched)
    base = " ".join(f"b{i}" for i in range(100))
    rows = [(i, base + "".join(f" t{i}.{j}" for j in range(15))) for i in range(90)]  # 96 of 126 tokens shared
    rows += [(100 + i, f"{t} end") for i, t in rows[:5]]
    got = ngram_join.similar_documents(frame_of(spark, rows, tmp_path_factory)).collect()
    assert sets_of((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sets_of(brute_components(rows, 5, 80))
    tasks = [tuple(map(int, p.name.split("-")[:2])) for p in tmp_path.iterdir()]
    assert sum(q for _, q in tasks) > 90 * 111  # the family did ask
    assert max(m for m, _ in tasks) < 4 * bound and max(q for _, q in tasks) < 4 * bound


def test_members_linked_through_different_leaders(spark, tmp_path_factory, monkeypatch):
    """Two members that follow different leaders may be each other's only link."""
    monkeypatch.setattr(ngram_join, "LEADERS", 1)
    rows = [(i, " ".join(f"w{j}" for j in range(10 * i, 10 * i + 110))) for i in range(8)]
    want = brute_components(rows, 5, 80)
    assert {c for _, _, c in want} == {0}  # each links with its neighbours only
    got = ngram_join.similar_documents(frame_of(spark, rows, tmp_path_factory)).collect()
    assert sets_of((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sets_of(want)


def test_a_family_of_near_copies_has_few_groups(spark, tmp_path_factory, monkeypatch):
    """Members whose own tokens lead every turn join their family's group: its tokens meet few groups."""
    rng, real, groups = random.Random(5), ngram_join._candidates, []

    def watched(docs, heads, shared, grouped, words, percent):
        groups.append(grouped.select("grp").distinct().count())
        return real(docs, heads, shared, grouped, words, percent)

    monkeypatch.setattr(ngram_join, "_candidates", watched)
    rows = []
    for i in range(300):
        words = [f"b{j}" for j in range(150)]
        for k in rng.sample(range(150), 6):
            words[k] = f"e{i}.{k}"
        rows.append((i, " ".join(words)))
    got = ngram_join.similar_documents(frame_of(spark, rows, tmp_path_factory)).collect()
    assert sets_of((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sets_of(brute_components(rows, 5, 80))
    assert groups[0] <= 5


@pytest.mark.parametrize("common_max", [0, 500_000])
def test_rare_and_common_tokens_find_the_same(spark, tmp_path_factory, monkeypatch, common_max):
    """All tokens through the packed buckets, or those of several texts through joins; small buckets and runs."""
    for name, value in (("COMMON_MAX", common_max), ("BUCKET_TOKENS", 50), ("PACKED_TOKENS", 200), ("ASKED_AT_ONCE", 30)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = near_copies(5)
    got = ngram_join.similar_documents(frame_of(spark, rows, tmp_path_factory), 4, 85).collect()
    assert sets_of((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sets_of(brute_components(rows, 4, 85))


@pytest.mark.parametrize("own", [100, 5])
def test_tokens_of_one_component_fill_the_first_places(own):
    """Texts that share a passage, few enough that it is not known as common, ask nothing if their own tokens come first."""
    import pandas as pd

    passage, many = np.arange(1, 21, dtype=np.int64), 40
    n = own + len(passage)
    later = n - (n - ngram_join.needed(n, 85) + ngram_join.overlap(n))
    ids = np.arange(many, dtype=np.int64)
    sets = [np.concatenate([passage, 1000 * (i + 1) + np.arange(own)]) for i in ids]
    cid, token = np.repeat(ids, n), np.concatenate(sets)
    bucket = pd.DataFrame({"cid": [np.diff(cid, prepend=0).tobytes()], "token": [token.tobytes()],
                           "comp": [np.zeros(len(token), np.int64).tobytes()]})
    held = ngram_join._held_by_several(bucket, 1)
    assert set(np.frombuffer(b"".join(held["token"]), np.int64)) == set(passage)
    assert set(np.frombuffer(b"".join(held["held"]), np.int64)) == {many}
    classes = pd.DataFrame({"cid": ids, "comp": ids, "grp": ids, "size": n, "later": later})
    first = ngram_join._first_tokens(classes, held, 1)
    asked = ngram_join._asking(first, 85) if len(first) else []
    kept = sum(len(t) // 8 for t in first["token"])
    assert kept == many * max(0, len(passage) - later)
    assert len(asked) == (0 if own == 100 else many * (many - 1))


# --- memory of reused workers ----------------------------------------------------------------------------

def test_a_worker_keeps_the_caches_of_one_operator(monkeypatch):
    """Python workers live as long as the application: packing's remembered chunks are gone when the join runs."""
    monkeypatch.setattr(common, "_KEPT", {"packing": {"path": "encoder"}, "ngrams": {}})
    pass_on = lambda batches: batches
    batch = pa.RecordBatch.from_pydict({"a": [1]})
    assert list(common.tidied("packing", pass_on)(iter([batch]))) == [batch]
    assert common.kept_by("packing") == {"path": "encoder"}
    assert list(common.tidied("ngrams", pass_on)(iter([batch]))) == [batch]
    assert common.kept_by("packing") == {}


def test_packing_keeps_its_encoders_where_others_let_them_go():
    import public_tokenizers

    from goldleaf.llm import packing
    encoder = packing._encoder(public_tokenizers.path(packing.TOKENIZER))
    assert packing._encoder(public_tokenizers.path(packing.TOKENIZER)) is encoder
    common.let_go_of_others("ngrams")
    assert not packing._ENCODERS


# --- row numbers -----------------------------------------------------------------------------------------

@pytest.fixture()
def other_splits(spark):
    """Changes how a table's files are dealt to tasks, as another number of cores would."""
    def change(parallelism, split):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", parallelism)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)

    yield change
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_row_numbers_do_not_depend_on_tasks(spark, tmp_path, other_splits):
    path = str(tmp_path / "t")
    spark.range(5000).selectExpr("id AS doc_id", "repeat(cast(id AS string), 50) AS text").repartition(13).write.option(
        "parquet.block.size", 4096).parquet(path)
    seen = []
    for parallelism, split in ((8, "128m"), (2, "128m"), (3, "4k")):
        other_splits(parallelism, split)
        docs = spark.read.parquet(path).where("doc_id % 7 <> 3").select("text", "doc_id")
        seen.append({r["doc_id"]: r["n"] for r in common.row_numbered(docs, "n").collect()})
        assert len(set(seen[-1].values())) == len(seen[-1]) and min(seen[-1].values()) >= 0
    assert seen[0] == seen[1] == seen[2]


def test_frames_that_are_no_scan_are_stored(spark):
    made = spark.range(20).withColumn("_metadata", F.lit(1))
    doubled = made.union(made)
    for frame in (made, doubled, doubled.join(made.select("id"), "id"), made.where("id < 0")):
        numbers = [r["n"] for r in common.row_numbered(frame, "n").collect()]
        assert len(set(numbers)) == len(numbers) == frame.count()


def test_stages_survive_a_change_of_cores(spark, tmp_path, other_splits, monkeypatch):
    """The number of tasks changes between any two scans of the documents."""
    path = str(tmp_path / "t")
    rows = [(i, " ".join(f"t{i % 400}w{j}" for j in range(40)) + (" end" if i % 3 == 0 else "")) for i in range(1200)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(11).write.parquet(path)
    turn, real = [0], common.written

    def moved(frame, name):
        turn[0] += 1
        out = real(frame, name)
        other_splits(1 + turn[0] % 7, ["128m", "8k"][turn[0] % 2])
        return out

    for module in (block_naming, ngram_join, corpus_pipeline):
        monkeypatch.setattr(module, "written", moved)
    docs = spark.read.parquet(path)
    once = corpus_pipeline.drop_copies(spark, docs, "")
    newest = {}
    for doc_id, text in rows:
        newest[text] = max(doc_id, newest.get(text, doc_id))
    kept = moved(once, "test-once")
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted((d, t) for t, d in newest.items())
    rest = [(r["doc_id"], r["text"]) for r in kept.collect()]
    got = corpus_pipeline.drop_near_copies(spark, kept, "").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(d for d, n, c in brute_components(rest, 5, 80) if d == c)


def test_connected_components(spark):
    rng = random.Random(9)
    chain = [(i, i + 1) for i in range(100, 140)]
    links = chain + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    rows = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    for a, b in links:
        if a is not None and a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    assert {r["node"]: r["root"] for r in rows} == {x: root(x) for x in list(parent)} and len(rows) == len(parent)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# --- mixing ----------------------------------------------------------------------------------------------

def test_weights_meet_the_targets(spark):
    rng = np.random.default_rng(2)
    cells = [(s, l, t, float(rng.integers(1, 1000))) for s in ("a", "b", None) for l in ("en", "fr") for t in ("x", "y")]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, mass double")
    want = {"source": {"a": 0.5, "b": 0.2, None: 0.3, "absent": 9.0}, "lang": {"en": 0.8, "fr": 0.2}, "topic": {"x": 0.5, "y": 0.5}}
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, share double") for d, v in want.items()}
    want["source"].pop("absent")
    rows = mixing.rake(frame, targets).collect()
    assert len(rows) == len(cells)
    # the same steps in numpy
    w = np.array([c[3] for c in cells]) / sum(c[3] for c in cells)
    for _ in range(200):
        for k, d in enumerate(mixing.DIMENSIONS):
            for value, share in want[d].items():
                at = np.array([c[k] == value for c in cells])
                w[at] *= share / w[at].sum()
    plain = {c[:3]: x for c, x in zip(cells, w)}
    for r in rows:
        assert abs(r["weight"] - plain[r["source"], r["lang"], r["topic"]]) < 1e-4
    for k, d in enumerate(mixing.DIMENSIONS):
        for value, share in want[d].items():
            assert abs(sum(r["weight"] for r in rows if r[d] == value) - share) < 1e-3


def test_raking_by_joins_and_in_one_task_agree(spark, monkeypatch):
    cells = spark.createDataFrame([(s, l, float(3 * len(s or "xyz") + len(l))) for s in ("a", "bb", None) for l in ("en", "fra")],
                                  "source string, lang string, mass double")
    targets = {"source": spark.createDataFrame([("a", 0.5), (None, 0.3), ("bb", 0.2)], "source string, share double"),
               "lang": spark.createDataFrame([("en", 1.0), ("fra", 3.0)], "lang string, share double")}
    few = {(r["source"], r["lang"]): r["weight"] for r in mixing.rake(cells, targets, 6, 0.0).collect()}
    monkeypatch.setattr(mixing, "FEW_CELLS", 0)
    many = {(r["source"], r["lang"]): r["weight"] for r in mixing.rake(cells, targets, 6, 0.0).collect()}
    assert few.keys() == many.keys() and all(abs(few[k] - many[k]) < 1e-12 for k in few)


def test_targets_that_cannot_be_met_are_told(spark):
    """Source a has only en, b only fr: the shares of sources and languages contradict each other."""
    cells = spark.createDataFrame([("a", "en", 1.0), ("b", "fr", 1.0)], "source string, lang string, mass double")
    targets = {"source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, share double"),
               "lang": spark.createDataFrame([("en", 0.2), ("fr", 0.8)], "lang string, share double")}
    with pytest.warns(UserWarning, match="not met its targets"):
        rows = mixing.rake(cells, targets).collect()
    assert max(r["drift"] for r in rows) > 0.1


def test_probabilities_meet_the_budget(spark):
    cells = spark.createDataFrame([("a", 10.0, 0.5), ("b", 100.0, 0.3), ("c", 1000.0, 0.2), ("d", 50.0, 0.0)],
                                  "source string, mass double, weight double")
    for share in (0.05, 0.3, 0.9):
        rows = mixing.probabilities(cells, share).collect()
        assert all(0 <= r["probability"] <= 1 for r in rows)
        assert abs(sum(r["mass"] * r["probability"] for r in rows) - share * 1160) < 1e-6


def test_sampling_plan_of_documents(spark, tmp_path_factory):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.sampling_plan(docs).collect()
    assert len(rows) == docs.count()
    expected, drawn, total = (sum(x) for x in zip(*[
        (r["n_tokens"] * r["probability"], r["n_tokens"] * r["kept"], r["n_tokens"]) for r in rows]))
    assert abs(expected / total - mixing.KEEP_SHARE) < 1e-6 and abs(drawn / total - mixing.KEEP_SHARE) < 0.03
    odd = frame_of(spark, [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, None)], tmp_path_factory).withColumn(
        "source", F.lit(None).cast("string")).withColumn("lang", F.lit("en"))
    got = mixing.sampling_plan(odd).collect()
    assert len(got) == len(ODD_TEXTS) + 1 and all(r["n_tokens"] >= 1 and 0 <= r["probability"] <= 1 for r in got)
    assert mixing.mix(odd, keep_share=1.0).columns == odd.columns and mixing.mix(odd, keep_share=1.0).count() == len(got)
    assert mixing.sampling_plan(odd.where("doc_id < 0")).collect() == []


def test_texts_without_spaces_weigh_by_length(spark):
    texts = [None, "", " \n", "a b c d", "中文" * 500, "x" * 4000, "the of and " * 100]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r["w"] for r in frame.orderBy("i").select(mixing.token_weight(F.col("text")).alias("w")).collect()]
    assert got == [1, 1, 1, 4, 750, 1000, 300]


# --- neighbours ------------------------------------------------------------------------------------------

def brute_neighbours(rows, query_id, vector, k=10):
    d = [(float(np.sqrt(((np.asarray(x, float) - np.asarray(vector, float)) ** 2).sum())), i) for i, x in rows if i != query_id]
    return sorted(d)[:k]


def test_neighbours_reach_the_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    vectors = dict(rows)
    found = defaultdict(list)
    for r in c2lsh.neighbours_of_table(table).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["score"], r["vec_id"]))
    assert set(found) == {i for i, _ in rows if i % 100 == 0}
    hits = 0
    for q, got in found.items():
        want = brute_neighbours(rows, q, vectors[q])
        hits += len({i for _, i in want} & {i for _, i in got})
        assert got == sorted(got) and len(got) == 10
        assert all(abs(s - brute_neighbours([(i, vectors[i])], q, vectors[q])[0][0]) < 1e-9 for s, i in got)
    assert hits / len(found) / 10 >= 0.95


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 1.0]), (9, [1.0, 1.0]), (None, [1.0, 0.0]), (200, [1.0, 2.0, 3.0]),
            (300, None)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id bigint, embedding array<float>, block int")
    got = c2lsh.neighbours_of_table(frame).orderBy("query_id", "rank").collect()
    valid = [(i, x) for i, x in rows if i in (0, 100, 1, 2, 9)]
    for q in (0, 100):
        mine = [(r["score"], r["vec_id"]) for r in got if r["query_id"] == q]
        assert mine == brute_neighbours(valid, q, dict(valid)[q])
        assert [r["rank"] for r in got if r["query_id"] == q] == list(range(1, len(mine) + 1))
    assert {r["query_id"] for r in got} == {0, 100}
    assert c2lsh.neighbours_of_table(frame.where("vec_id < 0")).collect() == []


def test_neighbours_over_many_blocks(spark, monkeypatch):
    """Blocks of about 250 vectors: most of a query's neighbours lie outside its first block."""
    monkeypatch.setattr(c2lsh, "BLOCK_VALUES", 16_000)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    vectors = dict(rows)
    found = defaultdict(list)
    for r in c2lsh.neighbours_of_table(table, every=40).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["score"], r["vec_id"]))
    assert set(found) == {i for i, _ in rows if i % 40 == 0}
    assert all(len(got) == 10 and len({i for _, i in got}) == 10 for got in found.values())
    hits = sum(len({i for _, i in brute_neighbours(rows, q, vectors[q])} & {i for _, i in got}) for q, got in found.items())
    assert hits / len(found) / 10 >= 0.95


def test_neighbours_among_copies(spark, monkeypatch):
    """A third of the rows is one vector: its copies are each other's nearest, ties to smaller ids, in all blocks."""
    monkeypatch.setattr(c2lsh, "BLOCK_VALUES", 800)
    draw = np.random.default_rng(3)
    rows = [(i, [0.25, 0.5, -1.0, 2.0] if i % 3 == 0 else draw.normal(size=4).round(3).tolist()) for i in range(1200)]
    frame = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    got = c2lsh.neighbours_of_table(frame).orderBy("query_id", "rank").collect()
    for q in (0, 300, 600, 900):
        assert [(r["score"], r["vec_id"]) for r in got if r["query_id"] == q] == brute_neighbours(rows, q, rows[q][1])
    far = spark.createDataFrame([(1, [1e200, 0.0]), (100, [1e200, 1e200]), (2, [-1e200, 1.0])], "vec_id int, embedding array<double>")
    assert {r["vec_id"] for r in c2lsh.neighbours_of_table(far).collect()} <= {1, 2}


def test_a_stream_of_queries_builds_one_index_per_block(monkeypatch):
    built = []

    class Counted(c2lsh.WindowIndex):
        def __init__(self, ids, x):
            built.append(len(ids))
            super().__init__(ids, x)

    monkeypatch.setattr(c2lsh, "WindowIndex", Counted)
    draw = np.random.default_rng(5)

    def batch(block, asked, ids):
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block] * len(ids), pa.int64()), "dim": pa.array([3] * len(ids), pa.int32()),
            "asked": pa.array([asked] * len(ids), pa.int32()), "vec_id": pa.array(ids, pa.int64()),
            "embedding": pa.array(draw.normal(size=(len(ids), 3)).tolist(), pa.list_(pa.float32())),
            "bound": pa.array([float("inf")] * len(ids))})

    batches = [batch(0, 0, range(40)), batch(0, 0, range(40, 60)), *[batch(0, 1, range(a, a + 300)) for a in range(0, 3000, 300)],
               batch(1, 1, range(5)), batch(2, 0, range(30)), batch(2, 1, range(7))]
    out = [r for b in c2lsh._search(iter(batches), 4) for r in b.to_pylist()]
    assert built == [60, 30]
    assert len(out) == 3000 * 4 + 7 * 4


# --- pipeline --------------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, sf), f"test-{name}")
        assert out.columns == columns
        steps[name] = ([tuple(r) for r in docs.collect()], [tuple(r) for r in out.collect()])
        assert set(steps[name][1]) <= set(steps[name][0])
        docs = out
    before, after = steps["exact_dedup"]
    newest = {}
    for doc_id, text, *_ in before:
        key = text.translate(LOWER)
        newest[key] = max(doc_id, newest.get(key, doc_id))
    assert sorted(r[0] for r in after) == sorted(newest.values())
    before, after = steps["ngram_jaccard_join"]
    linked = brute_components([r[:2] for r in before], 5, 80)
    assert sorted(r[0] for r in after) == sorted(d for d, n, c in linked if n == 0 or d == c)
    before, after = steps["mix_sources"]
    assert 0 < len(after) < len(before)
    rows = corpus_pipeline.pack_documents(docs).collect()
    check_packing(rows, [r[:2] for r in after], Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    assert sorted(r["doc_id"] for r in rows if r["piece"] == 0) == sorted(r[0] for r in after)


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        assert out.count() == 0
        docs = out
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(docs.columns)


def test_pipeline_keeps_rows_of_odd_tables(spark, tmp_path_factory):
    odd = frame_of(spark, [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, None), (None, "same TEXT")], tmp_path_factory)
    odd = odd.withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit("en"))
    odd = corpus_pipeline.written(odd, "test-odd")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        odd = corpus_pipeline.written(stage(spark, odd, "/root/testdata/sf0.001"), "test-odd")
        assert odd.count() > 0
    assert "uid" in odd.columns and odd.where("text = 'a'").count() <= 1


def test_near_copies_of_rows_without_or_with_repeated_ids(spark, tmp_path_factory):
    """Different texts under a null or a repeated doc_id are no copies of each other."""
    plain = lambda name, n=30: " ".join(f"{name}{i}" for i in range(n))
    rows = [(None, plain("a")), (None, plain("b")), (None, plain("c")), (5, plain("d")), (5, plain("e")), (5, plain("f")),
            (None, plain("g", 60)), (9, plain("g", 60) + " end"), (8, plain("g", 60) + " stop"),
            (None, plain("h", 60)), (None, plain("h", 60) + " end"), (None, None), (None, ""), (5, plain("e"))]
    docs = frame_of(spark, rows, tmp_path_factory)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    # of the texts g the one with the smallest id; of the texts h, which have no id, any one
    assert len([t for d, t in got if d is None and t in (rows[9][1], rows[10][1])]) == 1
    assert sets_of(x for x in got if x not in rows[9:11]) == sets_of([*rows[:6], rows[8], rows[11], rows[12]])
