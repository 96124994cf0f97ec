import re

from shelfspark.llm import licenses
from tests.llm.helpers import EDGES, documents, empty

MIT = next(t for t, label in licenses.NOTICES.items() if label == "mit")


def brute(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.encode().split()]
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


ROWS = EDGES + [
    (30, "Licensed under the GNU General Public License; and the gnu general public-license, MIT/license? Apache License"),
    (31, "CC-BY cc by CC BY. GNU General Public Domain gnu general public"),
    (32, MIT.capitalize()),
    (33, MIT.replace("free of charge", "free of any charge at all").replace("copy of", "copy")),
    (34, " ".join(MIT.split()[:8])),
    (35, "apache license " * 500),
]


def test_base_phrases_match_brute_force(spark):
    out = licenses.scan(documents(spark, ROWS)).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out) if False else sorted(((r.doc_id or -1, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out), key=str)
    assert got == sorted(((d or -1, *brute(t)) for d, t in ROWS), key=str)


def test_notices_are_verified(spark):
    by_id = {r.doc_id: r for r in licenses.scan(documents(spark, ROWS)).collect()}
    assert by_id[32].labels == "mit" and by_id[32].base_labels == "" and by_id[32].score == 1.0
    assert by_id[33].labels == "mit" and 0.7 <= by_id[33].score < 1.0
    assert by_id[34].labels == "" and by_id[34].score == 0.0
    assert by_id[35].n_base == 500 and by_id[35].labels == "apache"
    assert licenses.scan(empty(spark)).count() == 0


def test_query_on_whole_table(spark):
    from shelfspark.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in QUERIES["op5_license_scan"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {r.doc_id: brute(r.text) for r in rows}
