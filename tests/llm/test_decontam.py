import random

import numpy as np

from tarnwork.llm.decontam import TOKEN, Items, Search, best_match, embed, leaks, op10_decontamination, without_leaks

VOCABULARY = [a + b for a in "the of and re in st on er".split() for b in "ab cd ef gh ij kl mn op".split()]


def distance(a, b):
    """Least edit distance of ``a`` to any part of ``b``, by the plain recurrence."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = rng.choice(VOCABULARY)
        elif kind == 1 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, "new" + str(rng.randrange(99)))
    return words


def corpus(seed=3, n=150):
    rng = random.Random(seed)
    say = lambda k: [rng.choice(VOCABULARY) for _ in range(k)]
    items = [say(rng.randint(5, 50)) for _ in range(25)]
    docs = []
    for i in range(n):
        words = say(rng.randint(0, 200))
        if i % 3 == 0:
            item = rng.choice(items)
            at = rng.randint(0, len(words))
            words[at:at] = edited(rng, item, rng.randint(0, int(0.3 * len(item))))
        docs.append((i, " ".join(words).upper() if i % 2 else ", ".join(words)))
    return docs, [(100 + k, " ".join(w)) for k, w in enumerate(items)]


def brute(docs, items, share=0.2):
    out = {}
    for doc_id, text in docs:
        words = [w.lower() for w in TOKEN.findall(text or "")]
        for item_id, item in items:
            own = TOKEN.findall(item)
            if len(own) >= 5 and (d := distance(own, words)) <= int(share * len(own) + 1e-9):
                out[doc_id, item_id] = d
    return out


def test_against_brute_force(frame):
    docs, items = corpus()
    wanted = brute(docs, items)
    rows = leaks(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in rows}
    assert len(found) == len(rows) and set(found) <= set(wanted)
    assert len(found) >= 0.98 * len(wanted) and len(wanted) > 25
    assert all(d == wanted[k] for k, d in found.items())
    words = {i: [w.lower() for w in TOKEN.findall(t)] for i, t in docs}
    names = dict(items)
    assert all(distance(names[r.item_id].split(), words[r.doc_id][r.start_word : r.end_word]) == r.distance for r in rows)


def test_recall_at_the_edit_bound():
    rng, search, hit, places = random.Random(9), Search(), 0, []
    for _ in range(150):
        item = [rng.choice(VOCABULARY) for _ in range(rng.randint(10, 60))]
        text = edited(rng, item, search.edits(len(item)))
        hit += bool(Items([" ".join(item)], search).find("x1 x2 " + " ".join(text) + " x3"))
        code = {w: i + 1 for i, w in enumerate(dict.fromkeys(item + text))}
        a, b = (embed(np.array([code[w] for w in x]), np.zeros(1, np.int64), len(item), search) for x in (item, text))
        places.append((a != b).mean())
    assert hit >= 0.99 * 150
    assert np.mean(places) < search.differing


def test_best_match():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(1, 5) for _ in range(rng.randint(1, 12))] for _ in range(2))
        d, start, end = best_match(np.array(a), np.array(b))
        assert d == distance(a, b)
        assert 0 <= start <= end <= len(b) and best_match(np.array(a), np.array(b[start:end] or [0]))[0] == d


ITEM = "one two three four five six seven eight nine ten"


def test_odd_rows(frame):
    docs = [(1, None), (2, ""), (3, ITEM), (3, ITEM), (None, "x " * 30_000 + ITEM), (4, ITEM.replace("three", "tree").replace(" ", "\n")), (5, "one two"), (6, ITEM * 2)]
    items = [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "one"), (None, "never seen in any of the texts here")]
    df = frame([(*d, "c", 1) for d in docs], "doc_id long, text string, item_id string, distance int")
    found = leaks(df, frame(items, "item_id long, text string")).collect()
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append((r.item_id, r.distance, r.start_word))
    assert by_doc == {3: [(1, 0, 0)] * 4, None: [(1, 0, 30_000)] * 2, 4: [(1, 1, 0)] * 2, 6: by_doc[6]}
    clean = without_leaks(df, frame(items, "item_id long, text string"))
    assert clean.columns == df.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2, 5]


def test_short_items_and_scripts_without_spaces(frame):
    question = "世界上最長的河流是哪一條,它流經多少個國家"
    items = [(1, "What is 2 + 2?"), (2, question), (3, "そうですか"), (4, "ประเทศไทยมีกี่จังหวัด"), (5, "of it"), (6, "of it")]
    docs = [(1, "so, what is 2 and 2; what is 2+2"), (2, f"前面還有許多別的話{question.replace(',', '')}後面也有"), (3, "x そうですね y"), (4, "what is 2 + 3"), (5, f"ก่อน{items[3][1]}หลัง"), (6, "end of it")]
    docs += [(7, "前面還有許多" + question.replace("最長", "最大") + "後面"), (8, "世界上的河流"), (9, "it of"), (10, None)]
    frames = frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.distance, r.end_word - r.start_word) for r in leaks(*frames).collect()}
    assert found == {(1, 1): (0, 4), (2, 2): (0, 20), (3, 3): (1, found[3, 3][1]), (5, 4): (0, len(items[3][1])), (6, 5): (0, 2), (6, 6): (0, 2), (7, 2): (1, 20)}
    assert sorted(r.doc_id for r in without_leaks(*frames).collect()) == [4, 8, 9, 10]
    only_short = Items(["What is 2 + 2?"], Search())
    assert only_short.find("what is 2 2") and not only_short.find("what is 2 3")


def test_blocks_and_empty_tables(frame):
    docs, items = corpus(5, 60)
    d, b = frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")
    assert sorted(leaks(d, b).collect()) == sorted(leaks(d, b, block_words=100).collect())
    assert leaks(d.limit(0), b).collect() == [] == leaks(d, b.limit(0)).collect()


def test_all_documents(spark, sf_dir):
    found = {(r.doc_id, r.item_id) for r in op10_decontamination(spark, sf_dir).collect()}
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {r.doc_id: " ".join(TOKEN.findall((r.text or "").lower())) for r in documents}
    exact = {(d, i) for i, t in items for d, x in texts.items() if " ".join(TOKEN.findall(t.lower())) in x}
    assert exact and exact <= found
