"""Rows that share an id are taken one by one at a source's threshold."""

from titlematch.llm import mixing


def test_rows_with_one_id_are_split(spark):
    rows = [(7, "same five words each time", "a", i) for i in range(200)]  # repeated rows
    rows += [(None, f"no id {i} here", "b", i) for i in range(300)]  # null ids, other texts
    rows += [(None, "no id no", "b", 300 + i) for i in range(40)] + [(1000 + i, f"own id {i}", "c", i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place long").repartition(5)
    taken, target, largest = {}, {}, {}
    for r in mixing.mix(docs).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source], largest[r.source] = r.target, max(largest.get(r.source, 0), r.size)
    for s in "abc":
        assert abs(taken[s] - target[s]) <= largest[s] / 2
    words = {}
    for r in mixing.mixed_documents(docs).collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    assert words == taken
