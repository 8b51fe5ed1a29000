"""How much a task summarises at once."""

import pyarrow as pa

from lakestrata.llm import collocations


def test_a_summary_holds_some_million_phrases_at_most():
    text = " ".join(f"w{i % 5000}" for i in range(800_000))
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array(["en"])], ["text", "lang"])
    masses = [sum(b.column("mass").to_pylist()) for b in collocations._summarise(3)(iter([batch]))]
    assert sum(masses) == 4 * 800_000 - 6
    assert max(masses) < 1_600_000
