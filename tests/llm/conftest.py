import pytest

from incident_stream.llm.common import importable

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, first=0):
    """A table of documents; a pair gives its own id."""
    rows = [
        (*(t if isinstance(t, tuple) else (first + i, t)), "en", "src0", 1)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def prose(seed, n, vocabulary=400):
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


WORDS = rb"[^\x20\x09-\x0D]+"


def components_of(ids, links):
    """Smallest reachable id, by plain search."""
    near = {i: set() for i in ids}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    root = {}
    for i in sorted(near):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo.extend(near[x])
    return root
