"""Links between paragraphs against all pairs, where many paragraphs share a passage and few are alike."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from tillstream.llm import paragraphs
from tillstream.llm.batches import spaced_words
from tillstream.llm.components import components


def test_crowd_with_a_passage_in_common(spark):
    dice = random.Random(7)
    word = lambda: "".join(dice.choice("abcdefghijklmnop") for _ in range(7))
    shared, texts = [word() for _ in range(40)], []
    for _ in range(120):
        own = [word() for _ in range(30)]
        texts.append(shared + own)
        if dice.random() < 0.3:  # a near copy: a word or two of the own part replaced
            near = list(own)
            for _ in range(dice.randint(1, 2)):
                near[dice.randrange(len(near))] = word()
            texts.append(shared + near)
    sets = [frozenset(tuple(t[k : k + paragraphs.SHINGLE]) for k in range(len(t) - paragraphs.SHINGLE + 1)) for t in texts]
    alike = [
        (a, b) for a in range(len(texts)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= paragraphs.PERCENT * len(sets[a] | sets[b])
    ]
    root = list(range(len(texts)))
    for _ in texts:
        for a, b in alike:
            root[a] = root[b] = min(root[a], root[b])
    want = sorted(n for n in (root.count(r) for r in set(root)) if n > 1)
    assert want  # some are alike
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    found = components(paragraphs.near_paragraphs(docs)).groupBy("root").count().collect()
    assert sorted(r["count"] for r in found) == want


@pytest.mark.parametrize("texts", [[], [None], ["", None], [" \n "]])
def test_slices_without_words(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    units = paragraphs.Units(batch, spaced_words())
    runs, ahead = units.paragraph_shingles()
    assert len(units.low) == len(units.high) == len(units.hash) == len(runs) == 0 and list(ahead) == [0]
