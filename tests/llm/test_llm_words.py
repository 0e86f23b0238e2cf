import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, split, texts
from pyspark.sql import functions as F

from dayfold.llm.jaccard_join import Sets, folded, jaccard_join, near
from dayfold.llm.lm_score import score_texts
from dayfold.llm.substring_dedup import substring_dedup
from dayfold.llm.words import words_of



def test_words_and_hashes_are_those_of_the_bytes():
    rows = [t for _, t in texts()]
    for lower in (False, True):
        words = words_of(pa.array(rows, pa.string()), lower)
        expected = [split(t, lower) for t in rows]
        assert words.counts.tolist() == [len(w) for w in expected]
        found = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends)]
        flat = [w for ws in expected for w in ws]
        assert found == flat
        of = {}
        for word, h in zip(flat, words.hashes.tolist()):
            assert of.setdefault(word, h) == h
        assert len(set(of.values())) == len(of)


def test_sliced_and_chunked_arrays():
    array = pa.array(["a b", "c", None, "d e f"], pa.string())
    assert words_of(array.slice(1)).counts.tolist() == [1, 0, 3]
    assert words_of(pa.chunked_array([array, array])).counts.tolist() == [2, 1, 0, 3] * 2
    assert words_of(pa.array([], pa.string())).counts.tolist() == []


def thue_morse(n):
    """Two words of the same length that differ everywhere, but agree in all sums of
    powers of places up to a high degree."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [8, 16, 64, 128, 1_024, 2_048, 4_096])
def test_words_made_to_collide_do_not(n):
    one, two = words_of(pa.array([" ".join(thue_morse(n))])).hashes
    assert one != two


def test_operators_tell_words_made_to_collide(spark):
    rows = []
    for i, n in enumerate((1_024, 2_048, 4_096)):
        one, two = thue_morse(n)
        rest = " ".join(f"w{i}x{j}" for j in range(24))
        rows += [(10 * i, f"{one} {rest}"), (10 * i + 1, f"{two} {rest}")]
    docs = documents(spark, rows)
    removed = {r["doc_id"]: r["n_removed"] for r in substring_dedup(docs).collect()}
    assert removed == {i: 24 * (i % 10) for i, _ in rows}
    groups = {r["doc_id"]: r["component_id"] for r in jaccard_join(docs, words=3, percent=95).collect()}
    assert groups == {i: i for i, _ in rows}
    known = {r["doc_id"]: r["n_known"] for r in score_texts(docs, F.col("doc_id") % 10 == 0).collect()}
    assert known == {i: 26 - i % 10 for i, _ in rows}


def test_sketches_differ_in_no_more_places_than_sets():
    rng = np.random.default_rng(5)
    texts_of = []
    for _ in range(60):
        words = [f"w{w}" for w in rng.integers(0, 400, rng.integers(3, 300))]
        near_copy = list(words)
        near_copy[rng.integers(len(words))] = "other"
        texts_of += [" ".join(words), " ".join(near_copy)]
    sets = Sets(pa.array(texts_of), 2)
    sketches = sets.sketches()
    of = [set(sets.hashes[a:b].tolist()) for a, b in zip(sets.offsets, sets.offsets[1:])]
    linked = set()
    for i in range(0, len(of), 2):
        for j in range(i + 1, len(of)):
            size = min(len(sketches[i]), len(sketches[j]))
            differ = np.bitwise_count(folded(sketches[i], size) ^ folded(sketches[j], size)).sum()
            assert differ <= len(of[i] ^ of[j])
            if 100 * len(of[i] & of[j]) >= 80 * len(of[i] | of[j]):
                linked.add((i, j))
    one, two = near(sets.sizes, sketches, np.zeros(len(of), int), 80)
    found = set(zip(one.tolist(), two.tolist()))
    assert linked and linked <= found and len(found) < 3 * len(linked)
    block = np.arange(len(of)) % 2
    one, two = near(sets.sizes, sketches, block, 80)
    assert {tuple(sorted(p)) for p in zip(one.tolist(), two.tolist())} == {
        (i, j) for i, j in found if i % 2 != j % 2
    }
