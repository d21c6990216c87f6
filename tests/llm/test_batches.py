import pyarrow as pa

from lodestock.llm import batches


def test_memory_goes_back_after_long_texts_and_at_the_end(monkeypatch):
    seen = []
    monkeypatch.setattr(batches, "give_back", lambda: seen.append("back"))
    texts = ["a", "b" * 20, None, "", "cc", "d" * 30]
    for block in batches.blocks(iter([pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})]), "text", 10):
        seen.append(block.column("text").to_pylist())
    assert seen == [["a"], ["b" * 20], "back", [None, "", "cc"], ["d" * 30], "back", "back"]


def test_no_batches_and_a_library_without_the_call(monkeypatch):
    monkeypatch.setattr(batches, "_trim", lambda: None)
    assert list(batches.blocks(iter([]), "text")) == []
    batches.give_back()
