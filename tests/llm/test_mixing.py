"""The mix: layout, targets, permutations and totals."""

import os
import re

import numpy as np
import pytest

from trustflow.llm import mixing as m, store

SCHEMA = "doc_id long, text string, source string"


def plain_targets(sizes, weights=(5, 2, 1), repeats=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while True:
        share = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * share > repeats * sizes[s]}
        if not over:
            return target | {s: weight[s] * share for s in free}
        for s in over:
            target[s] = repeats * sizes[s]
            left -= target[s]
        free -= over


def rows_of(rng, n=400):
    out = []
    for i in range(n):
        source = rng.choice(["a", "b", "c", None, "é", "tiny", "hot", "hot", "hot", "hot"])
        size = 2 if source == "tiny" else int(rng.integers(0, 400))
        out.append((i, " ".join(["w"] * size) if size else rng.choice([None, "", " \n"]), source))
    return [(i, None if t is None else str(t), None if s is None else str(s)) for i, t, s in out]


@pytest.mark.parametrize("size", [1, 2, 3, 64, 1000, 4097])
def test_permuted_is_a_permutation(size):
    out = m.permuted(np.arange(size), size, 6, 1, 2)
    assert sorted(out) == list(range(size))
    assert size < 64 or list(out) != list(m.permuted(np.arange(size), size, 6, 1, 3))


def test_totals_targets_and_limits(spark):
    rows = rows_of(np.random.default_rng(4))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: r for r in m.mix(df, block_words=16, shard_slots=256).collect()}
    size = {i: len((t or "").split()) for i, t, _ in rows}
    assert {i: r["size"] for i, r in got.items()} == size
    sizes = {}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for i, _, s in rows:
        assert got[i].source_size == sizes[s]
        assert got[i].target == pytest.approx(want[s])
        assert 0 <= got[i].taken <= 3 * size[i]
        taken[s] += got[i].taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 16 * 4


def test_reruns_agree_however_rows_are_partitioned(spark):
    rows = rows_of(np.random.default_rng(5), 150)
    one = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    many = spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)
    first, second = ({(r.id, r.taken) for r in m.mix(d, block_words=8).collect()} for d in (one, many))
    assert first == second


def test_slots_use_each_block_before_any_again(spark):
    rows = rows_of(np.random.default_rng(6), 200)
    docs = m.sized(spark.createDataFrame(rows, SCHEMA))
    sources = m.targets(docs, block_words=16).cache()
    slots = m.slots(spark, sources, shard_slots=64).collect()
    info = {r.source_no: r for r in sources.collect()}
    by = {}
    for s in slots:
        by.setdefault(s.source_no, {}).setdefault(s.block, 0)
        by[s.source_no][s.block] += 1
    assert {n: sum(v.values()) for n, v in by.items()} == {n: r.quota for n, r in info.items() if r.quota}
    for n, counts in by.items():
        times = [counts.get(b, 0) for b in range(info[n].n_blocks)]
        assert max(times) - min(times) <= 1
    assert len({(s.shard, s.slot) for s in slots}) == len(slots)
    assert max(s.slot for s in slots) < 64


def test_empty_table_and_no_words(spark):
    assert m.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(r.id, r["size"], r.target, r.taken) for r in m.mix(spark.createDataFrame([(1, None, None), (None, "", "a")], SCHEMA)).collect()]
    assert sorted(rows, key=str) == [(1, 0, 0.0, 0), (None, 0, 0.0, 0)]


def test_running_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "s", 9), (1, "a b", "s", 9)], SCHEMA + ", size int")
    assert [(r["size"], r.taken) for r in m.mix(df, block_words=2).collect()] == [(2, 2), (2, 2)]


def texts_of(rng, n=300):
    """Documents whose words are all different."""
    return [(i, " \n".join(f"w{i}.{j}" for j in range(t.count("w"))) if t and t.strip() else t, s) for i, t, s in rows_of(rng, n)]


def test_blocks_rebuild_every_document(spark):
    rows = texts_of(np.random.default_rng(7))
    df = spark.createDataFrame(rows, SCHEMA)
    sources, numbered = m._numbered(df, "doc_id", "text", "source", (5, 2, 1), 3, 16, True)
    found = m.blocks(m.layout(numbered, 20), 16).orderBy("source_no", "block").collect()
    n_blocks = {r.source_no: r.n_blocks for r in sources.collect() if r.n_blocks}
    assert {n: sorted(b.block for b in found if b.source_no == n) for n in n_blocks} == {n: list(range(k)) for n, k in n_blocks.items()}
    texts = {}
    for b in found:
        words = b.words.split(" ")
        assert len(words) == sum(p.n for p in b.parts) and (len(words) == 16 or b.block == n_blocks[b.source_no] - 1)
        for p in b.parts:
            texts.setdefault(p.id, []).extend(words[: p.n])
            words = words[p.n :]
    assert texts == {i: t.split() for i, t, _ in rows if t and t.split()}


def test_shards_hold_the_mix(spark):
    rows = texts_of(np.random.default_rng(8))
    df = spark.createDataFrame(rows, SCHEMA)
    mixed, report = m.write_mix(df, block_words=16, shard_slots=64)
    got = mixed.collect()
    places = sorted((r.shard, r.slot) for r in got)
    shards = {s for s, _ in places}
    assert len(set(places)) == len(places) and shards == set(range(len(shards))) and len(shards) > 3
    assert all([x for s, x in places if s == n] == list(range(64)) for n in shards - {max(shards)})
    source = {i: s for i, _, s in rows}
    taken = {}
    for r in got:
        words = r.words.split(" ")
        for p in r.parts:
            assert source[p.id] == r.source and {w.split(".")[0] for w in words[: p.n]} == {f"w{p.id}"}
            words = words[p.n :]
            taken[p.id] = taken.get(p.id, 0) + p.n
        assert not words
    want = {r.id: r.taken for r in m.mix(df, block_words=16, shard_slots=64).collect()}
    assert taken == {i: n for i, n in want.items() if n}
    assert {r.id: r.taken for r in report.collect()} == want
    assert sum(r.taken for r in m.taken_of(mixed).collect()) == sum(want.values())
    again, _ = m.write_mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5), block_words=16, shard_slots=64)
    assert {(r.shard, r.slot, r.words) for r in again.collect()} == {(r.shard, r.slot, r.words) for r in got}


def test_shards_of_odd_rows(spark):
    for rows, n in ([], 0), ([(1, None, None), (None, " ", "a")], 2):
        mixed, report = m.write_mix(spark.createDataFrame(rows, SCHEMA))
        assert (mixed.count(), report.count()) == (0, n)
    long = spark.createDataFrame([(None, "x " * 300_000, None), (2, "a", "s"), (2, "a", "s")], SCHEMA)
    mixed, report = m.write_mix(long)
    assert sum(p.n for r in mixed.collect() for p in r.parts if p.id is None) > 290_000 and report.count() == 3


def test_texts_move_twice_and_are_stored_once(spark, sf_dir, monkeypatch, capsys):
    """The shards are all that is stored of the texts; on the way there, texts pass two exchanges."""
    path = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01", "documents.parquet")
    documents = spark.read.parquet(path).select("doc_id", "text", "source")
    paths, plans, keep, new_path = [], {}, store.keep, store.new_path

    def explained(df, label, **options):
        capsys.readouterr()
        df.explain("formatted")
        plans[label] = capsys.readouterr().out
        return keep(df, label, **options)

    monkeypatch.setattr(store, "keep", explained)
    monkeypatch.setattr(store, "new_path", lambda *x: paths.append(new_path(*x)) or paths[-1])
    m.write_mix(documents)
    found = [os.path.join(d, f) for path in paths for d, _, names in os.walk(path) for f in names]
    assert sum(map(os.path.getsize, found)) < os.path.getsize(path)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plans["shards"])
    assert len([x for x in moved if re.search(r"\b(text|words|chunk|parts)#", x)]) == 2


BLANKS = ["a\u00a0b c", "x\u0085y z", "1\x1c2 3", "\u2003 \u3000", "\x00 \x00", "é\x0bü\x0cß\r\nñ\t日本", " lead", "trail \n", " \t", "", None]


def test_words_are_the_same_in_both_readings(spark):
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(BLANKS)], SCHEMA)
    first = {r.row.doc_id: (r["size"], r.text_hash) for r in m.sized(df).collect()}
    second = {r.id: (r["size"], r.text_hash) for r in m.packed(df).collect()}
    assert first == second and [first[i][0] for i in range(len(BLANKS))] == [len(re.findall(m.WORD, t or "")) for t in BLANKS]
    mixed, _ = m.write_mix(df, repeats=1, block_words=4)
    words = sorted(w for r in mixed.collect() for w in r.words.split(" "))
    assert words == sorted(w for t in BLANKS for w in re.findall(m.WORD, t or ""))


def test_repeated_rows_and_small_chunks(spark, monkeypatch):
    rows = [(f"d{i % 7}", f"a{i % 7} b c " * (i % 7 * 9), "hot" if i % 3 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string")
    mixed, report = m.write_mix(df, block_words=8, shard_slots=32)
    found = {(r.shard, r.slot, r.words, tuple(r.parts)) for r in mixed.collect()}
    sums = {}
    for _, _, _, parts in found:
        for p in parts:
            sums[p.id] = sums.get(p.id, 0) + p.n
    counted = report.collect()
    assert len(counted) == 120 and all(r.taken <= 3 * r["size"] for r in counted)
    assert sums == {i: n for i in {r.id for r in counted} if (n := sum(r.taken for r in counted if r.id == i))}
    assert sorted((r.id, r.source or "", r.taken) for r in counted) == sorted(
        (r.id, r.source or "", r.taken) for r in m.mix(df, block_words=8, shard_slots=32).collect()
    )
    monkeypatch.setattr(m, "HELD_BYTES", 50)
    again, _ = m.write_mix(df.repartition(3), block_words=8, shard_slots=32)
    assert {(r.shard, r.slot, r.words, tuple(r.parts)) for r in again.collect()} == found
