import random
from collections import Counter

import corpus
from storeledger.llm import lines


def brute(rows, ratio, least):
    hosts, seen = Counter(), Counter()
    for _, text, host in rows:
        hosts[host] += 1
        seen.update({(host, line) for line in (text or "").split("\n") if text is not None and line.strip(" ")})
    out = []
    for doc_id, text, host in rows:
        if text is None:
            out.append((doc_id, None, 0))
            continue
        kept = [x for x in text.split("\n") if not (seen[host, x] >= least and seen[host, x] > ratio * hosts[host])]
        out.append((doc_id, "\n".join(kept), len(text.split("\n")) - len(kept)))
    return sorted(out, key=repr)


def test_matches_counts_by_host(spark):
    rng = random.Random(5)
    common = ["home | about", "cookie notice", "", " "]
    rows = []
    for i in range(300):
        host = rng.choice(["big"] * 6 + ["mid", "mid", "small", None])
        body = [rng.choice([*common, corpus.prose(rng, 6), "now and then" if rng.random() < 0.1 else "x" * rng.randint(1, 40)]) for _ in range(rng.randint(0, 8))]
        rows.append((i % 290, "\n".join(body) if rng.random() > 0.03 else None, host))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = [(r.doc_id, r.text, r.lines_dropped) for r in lines.drop_site_boilerplate(docs, ratio=0.1, min_pages=4).collect()]
    assert sorted(got, key=repr) == brute(rows, 0.1, 4)
    assert any(r[2] for r in got)


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, "a\nb", "h", "x", 5, "y")], "doc_id long, text string, source string, host string, lines_dropped int, _site string"
    )
    got = lines.drop_site_boilerplate(docs)
    assert got.columns == ["doc_id", "text", "source", "host", "_site", "lines_dropped"]
    assert got.collect()[0].asDict() == {"doc_id": 1, "text": "a\nb", "source": "h", "host": "x", "_site": "y", "lines_dropped": 0}
    assert lines.drop_site_boilerplate(docs.limit(0)).collect() == []


def test_a_page_repeating_a_line_counts_once(spark):
    docs = spark.createDataFrame([(i, "again\nagain\nagain" if i == 0 else f"own {i}", "h") for i in range(10)], "doc_id long, text string, source string")
    assert {r.lines_dropped for r in lines.drop_site_boilerplate(docs, ratio=0.1, min_pages=2).collect()} == {0}
