import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from tapflow.llm import neardup, rules
from tapflow.llm.words import slices

TEXT_MB = 8


def batch_of_texts() -> pa.RecordBatch:
    draw = np.random.default_rng(5)
    forms = np.array([f"w{i:x}" for i in range(4000)])
    texts = [" ".join(forms[draw.integers(0, len(forms), 400)]) for _ in range(TEXT_MB * 540)]
    return pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])


def peak_mb(work) -> float:
    """Most that Python and numpy held at once, beyond the batch."""
    batch = batch_of_texts()
    tracemalloc.start()
    for _, texts in slices(batch, "text"):
        work(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_shingles_of_a_batch_take_a_bounded_part_of_a_worker():
    def described(texts):
        values, begin = neardup.shingle_sets(texts, 5)
        neardup.signatures(values, begin)

    assert peak_mb(described) < 80


def test_measures_of_a_batch_take_a_bounded_part_of_a_worker():
    path = public_tokenizers.path("piece_bpe_32k.model")
    rules.model(path)
    assert peak_mb(lambda texts: rules.measure_slice(texts, path)) < 120
