"""Separator scan against direct counts."""

import numpy as np
import pytest

from pyspark.errors import PySparkException
from trustflow.llm import store, tokens


def test_counts_of_written_texts(spark, sf_dir, tmp_path):
    with open(tokens.TOKENIZER, "rb") as f:
        encode = tokens.encoding(f.read()).encode_ordinary
    rows = {r.doc_id: len(encode(r.text or "")) for r in store.table(spark, sf_dir, "documents").collect()}
    assert {r.doc_id: r.n_tokens for r in tokens.op4(spark, sf_dir).collect()} == rows


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_blocks_are_stitched(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    want = set()
    for name in range(5):
        ids = rng.choice([9, 9, 9, 5, 6, 7], size=rng.integers(0, 60)).astype("<u2") if name else np.array([1, 2, 3], dtype="<u2")
        if name == 4:
            ids = np.array([9, 9, 1, 9], dtype="<u2")
        ids.tofile(tmp_path / f"{name}.tokens")
        start, n = 0, 0
        for i, x in enumerate(ids):
            if x == 9:
                want.add((f"{name}.tokens", n, start, i - start, True))
                start, n = i + 1, n + 1
        if start < len(ids):
            want.add((f"{name}.tokens", n, start, len(ids) - start, False))
    files = tokens.files_in(spark, str(tmp_path))
    got = tokens.counts(files, str(tmp_path), separator=9, block_tokens=block)
    assert {tuple(r) for r in got.collect()} == want


def test_nulls_repeats_and_separators_in_text(spark, tmp_path):
    rows = [(1, None), (1, ""), (None, "a b"), (4, "<|endoftext|>"), (5, "x" * 200_000)]
    folder = str(tmp_path / "t")
    places = tokens.write(spark.createDataFrame(rows, "id long, text string").coalesce(1), folder)
    got = tokens.counts(tokens.files_in(spark, folder), folder, block_tokens=50).join(places, ["file", "ordinal"]).collect()
    by = sorted((r.id or 0, r.n_tokens) for r in got)
    assert by[:3] == [(0, 2), (1, 0), (1, 0)] and len(by) == 5 and all(r.closed for r in got)
    assert by[3][1] > 1


def test_empty_and_broken_files(spark, tmp_path):
    files = spark.createDataFrame([], "file string, bytes long")
    assert tokens.counts(files, str(tmp_path)).count() == 0
    (tmp_path / "odd.tokens").write_bytes(b"abc")
    with pytest.raises(PySparkException):
        tokens.counts(tokens.files_in(spark, str(tmp_path)), str(tmp_path)).collect()


def test_long_white_space_keeps_its_ids():
    with open(tokens.TOKENIZER, "rb") as f:
        ranks = f.read()
    plain, encode = tokens.encoding(ranks).encode_ordinary, tokens.encoder(ranks)
    rng = np.random.default_rng(3)
    for space in (" ", "\n", "\t", "\r\n", " \n", "\u3000", "\xa0 ", "\x85", "\u2003\u2028"):
        for n in (999, 1000, 1001, 2500):
            for before, after in (("", ""), ("a", ""), ("", "b"), ("it's", "'s 1"), ("x.", "...\x1f"), ("\x1c", "\x1c\u200b")):
                text = before + (space * n)[:n] + after
                assert encode(text) == plain(text), (space, n, before, after)
    for _ in range(20):
        text = "".join(rng.choice(["a", "b ", "\n" * 1200, " " * 1500, "7", "'s", "."], 30))
        assert encode(text) == plain(text)


def test_very_long_white_space(spark, tmp_path):
    rows = [(1, " " * 10_000_000 + "x"), (2, "\n" * 10_000_000), (3, "a" + "\r\n" * 3_000_000 + "b")]
    folder = str(tmp_path / "t")
    places = tokens.write(spark.createDataFrame(rows, "id long, text string"), folder)
    got = tokens.counts(tokens.files_in(spark, folder), folder).join(places, ["file", "ordinal"]).collect()
    assert len(got) == 3 and all(r.n_tokens > 1 for r in got)


def test_many_blocks_are_many_tasks(spark, tmp_path):
    np.full(2000, 9, dtype="<u2").tofile(tmp_path / "a.tokens")
    files = tokens.files_in(spark, str(tmp_path))
    got = tokens.counts(files, str(tmp_path), separator=9, block_tokens=1)
    assert got.count() == 2000
    # One file per task that found something.
    assert sum("separators" in f for f in got.inputFiles()) >= 2000 // tokens.TASK_BLOCKS
