import hashlib
import random
import re

from gridshard.llm import decontamination as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    doc, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(doc) - n + 1):
                if doc[j : j + n] == w[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add("" if item is None else str(item))
    ids = ",".join(sorted(found))
    return (len(doc), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(doc))


def cases(edge_rows):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(1, 22)))) for i in range(8)]
    items += [(8, None), (9, ""), (10, "!?."), (None, "Nobody's item"), (11, items[0][1]), (11, items[0][1]), (12, "Straße é")]
    rows = [r for r in edge_rows if r[0] != 8]
    for i in range(60):
        parts = [rng.choice(items)[1] or "x" for _ in range(3)] + [" ".join(rng.choice("abcdef") for _ in range(30))]
        rng.shuffle(parts)
        rows.append((100 + i, rng.choice([" ", ", ", "\n--"]).join(parts).title(), "en", "s"))
    rows.append((300, "nobody's ITEM straße É", "de", "s"))
    return rows, items


def check(got, rows, items):
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute(r.text, items)


def test_equals_brute_force_in_one_part_and_in_several(spark, make_docs, edge_rows):
    rows, items = cases(edge_rows)
    docs, benchmark = make_docs(rows), spark.createDataFrame(items, "item_id long, text string")
    check(D.contamination(docs, benchmark).collect(), rows, items)
    check(D.contamination(docs, benchmark, per_part=20).collect(), rows, items)
    clean = {r.text for r in D.uncontaminated(docs, benchmark).collect()}
    assert clean == {r[1] for r in rows if not brute(r[1], items)[4]}


def test_spans_are_places_in_the_original(spark, make_docs):
    benchmark = spark.createDataFrame([(1, "Quick, brown FOX")], "item_id long, text string")
    docs = make_docs([(1, "«The quick -- (Brown)\nfox! jumps; quick brown fox", "en", "s"), (2, None, "en", "s")])
    got = {(r.doc_id, r.passage) for r in D.hit_spans(docs, benchmark).collect()}
    assert got == {(1, "quick -- (Brown)\nfox"), (1, "quick brown fox")}


def test_empty_tables_and_clashing_names(spark, make_docs, edge_docs, no_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert {r.n_hit for r in D.contamination(edge_docs, nothing).collect()} == {0}
    assert D.contamination(no_docs, some).count() == 0
    kept = D.uncontaminated(edge_docs, some)
    assert kept.columns == edge_docs.columns and 4 not in {r.doc_id for r in kept.collect()}
    long = make_docs([(1, "x " * 200_000 + "one", "en", "s")])
    assert D.contamination(long, some).first().n_hit == 1
