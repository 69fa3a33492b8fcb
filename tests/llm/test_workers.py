"""What a Python worker holds from one task to the next."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from leadflow.llm import decontaminate, line_dedup, ngram_join, pieces, rarity, toxicity
from leadflow.llm.common import thrifty


def _tokenized():
    with open(pieces.MODEL, "rb") as file:
        model = SimpleNamespace(value=file.read())
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words, some more"]})
    out, = pieces._encode(model, True)(iter([batch]))
    assert out.column("parity").to_pylist() == [True]
    return out, pieces.codec(model.value)


def _kept():
    return pieces.codec.cache_info().currsize + pieces._reference.cache_info().currsize


def _others():
    @thrifty
    def plain(batches):
        yield from batches
    shared = SimpleNamespace(value={"^a": 1})
    return [plain, ngram_join._sign(5), ngram_join._sets(5), toxicity._letter_counts, toxicity._feature_counts(shared),
            toxicity._signals_of(shared, shared), toxicity._score(shared, shared, [0.0] * 5), line_dedup._count, ngram_join._mark]


@pytest.mark.parametrize("at", range(len(_others())))
def test_another_steps_task_lets_go_of_the_tokenizer(at, monkeypatch):
    monkeypatch.setattr(rarity.Counter, "batches", lambda self: iter(()))
    monkeypatch.setattr(rarity.Counter, "rows", lambda self, partition: iter(()))
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    first, tool = _tokenized()
    assert _kept() == 2
    again, same = _tokenized()
    assert same is tool and tool.known  # the step's next task finds it
    list(_others()[at](iter(())))
    assert _kept() == 0
    later, other = _tokenized()
    assert other is not tool and later.equals(first) and again.equals(first)


def test_tokenizer_remembers_few_words():
    """A worker's memory for words stays bounded, and what is forgotten is encoded again."""
    _, tool = _tokenized()
    texts = [" ".join(f"w{i}x{j}" for j in range(500)) for i in range(1000)]
    for at in range(0, len(texts), 100):
        tool.encode(tool.cut(texts[at:at + 100]))
    assert len(tool.known) + len(tool.older) <= (1 << 18) + 100_000  # and the words of one group
    first = tool.encode(tool.cut(texts[:1]))
    assert tool.tokenizer.decode(np.frombuffer(first[0], "<i4").tolist()).strip() == texts[0]


def _full_collections(spark):
    """Of this JVM, which is the executor too."""
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if not any(x in b.getName() for x in ("Young", "Copy", "Scavenge", "Concurrent")))


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_a_step_begins_with_a_collected_heap(spark, monkeypatch, stage):
    began = []

    def stopped(*args, **kwargs):
        began.append(_full_collections(spark))
        raise InterruptedError

    for module, job in ((toxicity, "without_toxic"), (line_dedup, "cut_lines"), (ngram_join, "one_of_each"),
                        (decontaminate, "without_leaks"), (pieces, "encode_texts")):
        monkeypatch.setattr(module, job, stopped)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *args: None)
    before = _full_collections(spark)
    with pytest.raises(InterruptedError):
        dict(corpus_pipeline.STAGES)[stage](spark, None, "")
    assert began[0] > before
