"""The mix against plain Python, and what of it is shuffled."""

import hashlib
import math
import random

from siltstone.llm import mixture, words

SCHEMA = "doc_id long, source string, text string, note string"


def _rows(spark, count=600, seed=3):
    draw = random.Random(seed)
    rows = []
    for at in range(count):
        source = draw.choice(["a", "b", "b", "c", "c", "c", "d", None, ""])
        size = 0 if source == "d" else draw.choice([0, 1, 5, 40])
        text = " ".join(draw.choice(["one", "two", "three"]) for _ in range(size)) or draw.choice([None, ""])
        rows.append((draw.choice([at, at, at, 7, None]), source, text, f"n{at}"))
    return rows + rows[:40]


def _plain(rows, targets):
    """note -> words taken, in the order of the rows' keys."""
    taken = {}
    for source, (size, target) in targets.items():
        own = [(r, len((r[2] or "").split())) for r in rows if r[1] == source]
        own.sort(key=lambda x: (hashlib.md5(f"{'' if x[0][0] is None else x[0][0]}:mix".encode()).hexdigest(), x[1]))
        epochs = math.floor(target / size) if size else 0
        rest, start = math.floor(target - epochs * size), 0
        for _, words_ in own:
            taken.setdefault((source, words_), []).append(epochs * words_ + max(0, min(words_, rest - start)))
            start += words_
    return {k: sorted(v) for k, v in taken.items()}


def test_taken_words_are_those_before_the_cut(spark):
    rows = _rows(spark)
    docs = spark.createDataFrame(rows, SCHEMA)
    for slots in (1, 3, 256):
        for keep in (True, False):
            found = mixture.mixture(docs, ["doc_id", "source", "note"], slots=slots, keep=keep).collect()
            assert sorted(r.note for r in found) == sorted(r[3] for r in rows)
            targets = {r.source: (r.source_size, r.target) for r in found}
            taken = {}
            for r in found:
                taken.setdefault((r.source, r.size), []).append(r.taken)
            assert {k: sorted(v) for k, v in taken.items()} == _plain(rows, targets)


def _below(node):
    yield node
    children = node.children()
    for at in range(children.size()):
        yield from _below(children.apply(at))


def test_texts_of_whole_slots_are_not_dealt_out(spark):
    docs = spark.createDataFrame(_rows(spark), SCHEMA)
    plan = mixture.mixed_documents(docs)._jdf.queryExecution().sparkPlan()
    unions = [x for x in _below(plan) if x.nodeName() == "Union"]
    assert len(unions) == 1
    whole, cut = ([x.nodeName() for x in _below(unions[0].children().apply(at))] for at in (0, 1))
    assert "BroadcastHashJoin" in whole
    assert not {"Window", "Sort", "SortMergeJoin", "Exchange"} & set(whole)
    assert "Window" in cut


def test_a_worker_gives_memory_back_at_the_end_of_a_task(monkeypatch):
    seen = []
    monkeypatch.setattr(words, "give_back", lambda: seen.append("back"))

    @words.gives_back
    def run(batches):
        for batch in batches:
            seen.append(batch)
            yield batch

    assert list(run([1, 2])) == [1, 2]
    assert seen == [1, 2, "back"]
