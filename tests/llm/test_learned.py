"""Language ID and decontamination: brute force on small texts, held-out accuracy, recall."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import decontaminate, langid


def test_forward_sums_over_all_segmentations():
    vocabulary = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "aba"]
    prob = np.array([[0.05, 0.1, 0.1, 0.2, 0.1, 0.2, 0.1, 0.05, 0.1], [0.3, 0.2, 0.1, 0.05, 0.05, 0.1, 0.05, 0.05, 0.1]])
    scorer = langid.Scorer(vocabulary, prob)
    words = ["a", "ab", "abba", "babab", "axb", "x"]
    for k, word in enumerate(words):
        marked, want = "▁" + word, np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
            ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(marked)]
            p = np.ones(2)
            for a, b in zip([0, *ends], ends):
                piece = marked[a:b]
                p *= prob[:, vocabulary.index(piece)] if piece in vocabulary else prob[:, -1] if b - a == 1 else 0
            want += p
        assert scorer.forward(words)[k] == pytest.approx(np.log(want))
        assert scorer.long_word(word) == pytest.approx(np.log(want))
    assert np.isfinite(scorer.long_word("ab" * 5000)).all()
    (total, n), (none, m) = scorer.texts(["AB, ab! a", ".. !"])
    assert total == pytest.approx(2 * scorer.forward(["ab"])[0] + scorer.forward(["a"])[0]) and n == 3
    assert none.tolist() == [0, 0] and m == 2


def test_fit_raises_the_likelihood():
    vocabulary = sorted({"▁t", "▁th", "the", "he", "e", "t", "h", "▁", "n", "en", "▁the", "th"})
    counts = {"the": 9, "then": 4, "hen": 2, "ten": 1}
    score = lambda p: sum(n * langid.Scorer(vocabulary, p[None]).long_word(w)[0] for w, n in counts.items())
    scores = [score(langid.fit(counts, vocabulary, r)) for r in (1, 2, 4, 8)]
    assert scores == sorted(scores) and scores[-1] > scores[0]


def test_held_out_accuracy_and_defined_results(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(10**9, None, "en", "x", 0), (10**9 + 1, "", None, "x", 0), (10**9 + 2, "123 ... --", "de", "x", 0), (None, "the", None, "x", 0), (10**9 + 4, "the and of " * 200_000, "en", "x", 0), (10**9 + 5, "the " + "x" * 100_000, None, "x", 0)], docs.schema)
    both = docs.unionByName(odd).selectExpr("*", "0 AS held_out", "'x' AS lang_pred", "1 AS r", "1 AS o")
    rows = langid.language_id(both).collect()
    assert len(rows) == 1006
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    apart = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.lang_pred == truth[r.doc_id] for r in apart) / len(apart) > 0.95
    by_id = {r.doc_id: r for r in rows}
    assert all((by_id[10**9 + k].lang_pred, by_id[10**9 + k].score) == ("und", 0.0) for k in range(3))
    assert by_id[10**9 + 4].lang_pred == "en" and by_id[10**9 + 5].lang_pred in set(truth.values())
    assert all(0 <= r.score <= 1 for r in rows) and by_id[None].lang_pred in set(truth.values())
    kept = langid.keep_identified(both)
    assert kept.columns == both.columns and Counter((r.doc_id, r.lang) for r in kept.collect()) == Counter((r.doc_id, r.lang_pred) for r in rows if r.lang_pred != "und")
    some = langid.keep_identified(both, languages=["de", "fr"])
    assert Counter((r.doc_id, r.lang) for r in some.collect()) == Counter((r.doc_id, r.lang_pred) for r in rows if r.lang_pred in ("de", "fr"))
    relabelled = both.withColumn("lang", both["lang"].substr(1, 0))
    assert langid.language_id(relabelled.where("lang IS NULL")).select("lang_pred").distinct().collect() == [("und",)]
    kept = langid.keep_identified(relabelled.where("lang IS NULL"))
    assert sorted(map(str, kept.collect())) == sorted(map(str, relabelled.where("lang IS NULL").collect()))  # no model, so nothing goes
    assert langid.language_id(both.limit(0)).count() == 0
    assert langid.keep_identified(both.limit(0)).count() == 0


LANGUAGES = {"aa": "kato muro pelin", "bb": "zibe wox fyq", "cc": "ütsch ßahn öl"}


@pytest.mark.parametrize("ids", ["null", "one", "negative"])
def test_the_ids_do_not_decide_what_is_learned(spark, ids):
    """20,000 rows whose ids are null, all the same, or negative, most of them one and the same row of one language."""
    draw = random.Random(5)
    rows = [(k, " ".join(draw.choices(words.split(), k=9)), lang) for lang, words in LANGUAGES.items() for k in range(2000)]
    rows += [(k, "kato kato", "aa") for k in range(14_000)]
    name = {"null": lambda k: None, "one": lambda k: 0, "negative": lambda k: -k}[ids]
    docs = spark.createDataFrame([(name(k), t, lang) for k, t, lang in rows], "doc_id long, text string, lang string").repartition(5)
    found = langid.language_id(docs, sample_texts=100).groupBy("lang_pred").count().collect()
    assert {r.lang_pred: r["count"] for r in found} == {"aa": 16_000, "bb": 2000, "cc": 2000}
    drawn = [sorted(map(tuple, langid.sample(docs.repartition(n), F.lit(True), 100, "text", "lang").collect())) for n in (1, 7)]
    assert drawn[0] == drawn[1] and Counter(lang for lang, _ in drawn[0]) == {"aa": 100, "bb": 100, "cc": 100}


def plain_prediction(text, names, vocabulary, prob):
    """The query's answer for one text, by plain sums over pieces, one language and word at a time."""
    if not re.search(r"[^\W\d_]", text or ""):
        return "und", 0.0
    number, words, total = {p: k for k, p in enumerate(vocabulary)}, text.lower().split(), []
    for own in prob:
        logs = 0.0
        for word in words:
            marked = "▁" + word.strip(langid.MARKS)
            ahead = [1.0]
            for end in range(1, len(marked) + 1):
                ahead.append(sum(ahead[a] * own[number[marked[a:end]] if marked[a:end] in number else -1] for a in range(end) if marked[a:end] in number or end - a == 1))
            logs += math.log(ahead[-1]) if len(marked) > 1 else 0.0
        total.append(logs)
    odds = [math.exp((t - max(total)) / math.sqrt(len(words))) for t in total]
    return names[total.index(max(total))], max(odds) / sum(odds)


def test_the_query_predicts_what_plain_sums_predict(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in langid.language_id(docs).collect()}
    vocabulary = langid.default_vocabulary()
    model = langid.train(docs, ~langid.held_out(), "text", "lang", vocabulary, langid.SAMPLE_TEXTS, langid.ROUNDS)
    names, pieces = sorted(model), langid.pieces(vocabulary)
    short = [r for r in docs.collect() if len(r.text or "") < 2500]
    assert len(short) > 100
    for r in short:
        lang, score = plain_prediction(r.text, names, pieces, [model[n] for n in names])
        assert rows[r.doc_id].lang_pred == lang and rows[r.doc_id].score == pytest.approx(score, rel=1e-6)


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for k, p in enumerate(pattern, 1):
        new = [k]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_edit_distance_is_exact():
    draw = random.Random(2)
    for _ in range(300):
        pattern = [draw.randrange(1, 6) for _ in range(draw.randrange(1, 80))]
        text = [draw.randrange(0, 6) for _ in range(draw.randrange(0, 90))]
        places = {}
        for k, x in enumerate(pattern):
            places[x] = places.get(x, 0) | 1 << k
        assert decontaminate.edits(places, len(pattern), text)[0] == distance(pattern, text)


def edited(words, n, draw, vocabulary):
    words = list(words)
    for _ in range(n):
        k, at = draw.randrange(3), draw.randrange(len(words))
        if k == 0:
            words[at] = draw.choice(vocabulary)
        elif k == 1:
            words.insert(at, draw.choice(vocabulary))
        elif len(words) > 1:
            del words[at]
    return words


def test_recall_and_precision_against_brute_force(spark):
    draw = random.Random(8)
    vocabulary = [f"w{int(draw.paretovariate(0.6))}" for _ in range(20_000)]
    items = [(k, [draw.choice(vocabulary) for _ in range(draw.choice([8, 12, 17, 30, 45, 100]))]) for k in range(60)]
    items += [(100, ["few", "words"]), (101, []), (102, ["short", "items", "stand", "whole", "or", "not"]), (103, list("没有空格的文本也要找到"))]
    docs, planted = [], {}
    for n in range(400):
        words = [draw.choice(vocabulary) for _ in range(draw.choice([0, 5, 60, 400]))]
        if n % 2:
            item, own = draw.choice(items[:60])
            at = draw.randrange(len(words) + 1)
            words[at:at] = edited(own, draw.randrange(math.floor(0.2 * len(own)) + 1), draw, vocabulary)
            planted[n] = item
        docs.append((n, draw.choice([" ", "\n"]).join(w.upper() + draw.choice(["", ".", ","]) for w in words)))
    docs += [(1010, "a few Words."), (1011, "few other words"), (1012, "x short items stand whole or not y"), (1013, "short items stand or not"), (1014, "他说：没有空格的文本也要找到。"), (1015, "没有空格的文章还要找到"), (1016, "没有空格")]
    docs += [(1000, None), (1001, ""), (1002, "- -- ."), (1003, "few words"), (None, " ".join(items[0][1])), (1004, "long " * 30_000 + " ".join(items[1][1]))]
    spaced = lambda t: [w for w in map(decontaminate.plain, re.sub("([\u4e00-\u9fff])", r" \1 ", t or "").split()) if w]
    most = lambda own: math.floor(0.2 * len(own)) if len(own) >= 8 else 0
    far = {(i, k): distance(own, spaced(t)) for i, t in docs for k, own in items if own}
    want = {(i, k) for i, t in docs for k, own in items if own and far[i, k] <= most(own)}
    assert {(1003, 100), (1010, 100), (1012, 102), (1014, 103), (1015, 103)} <= want and not {(1011, 100), (1013, 102), (1016, 103)} & want
    assert all((n, k) in want for n, k in planted.items())
    frame = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, item_id int, at_word string, edits int").repartition(4)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items] + [(None, None)], "item_id long, text string")
    found = decontaminate.contamination(frame, bench, words_a_block=900).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= want and len(got) >= 0.97 * len(want)
    exact = {(i, k) for i, t in docs for k, own in items if own and not far[i, k]}
    assert all(r.edits == far[r.doc_id, r.item_id] for r in found)
    assert exact <= got
    kept = decontaminate.clean(frame, bench, words_a_block=900)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in docs) - Counter({i for i, _ in got})
    assert decontaminate.contamination(frame.limit(0), bench).count() == 0
    assert decontaminate.contamination(frame, bench.limit(0)).count() == 0
    assert decontaminate.clean(frame, bench.limit(0)).count() == len(docs)


def at_the_limit(item, kind, draw):
    """The item with exactly as many edits of a kind as it may have."""
    words, most = list(item), math.floor(0.2 * len(item))
    if kind == "replace":
        for at in draw.sample(range(len(words)), most):
            words[at] = f"r{draw.randrange(50)}"
    elif kind == "delete":
        gone = set(draw.sample(range(len(words)), most))
        words = [w for k, w in enumerate(words) if k not in gone]
    else:
        for _ in range(most):
            words.insert(draw.randrange(1, len(words)), f"r{draw.randrange(50)}")
    return words


@pytest.mark.parametrize("n", [8, 16, 32, 64, 65, 128, 130, 300])
def test_recall_at_the_edit_limit(n):
    """Occurrences with as many edits as allowed, at every alignment: the repeats' target is reached for each size and kind of edit."""
    draw, item = random.Random(n), [f"i{k}" for k in range(n)]
    index = decontaminate.Index([("it", " ".join(item))], decontaminate.RATE, decontaminate.MIN_WORDS, decontaminate.COORDINATES, decontaminate.repeats_for(decontaminate.TARGET_RECALL))
    for kind in ("replace", "delete", "insert"):
        texts = [" ".join(["o"] * draw.randrange(2 * n) + at_the_limit(item, kind, draw) + ["o"] * draw.randrange(n)) for _ in range(500)]
        recall = len({h[0] for h in index.hits(texts)}) / len(texts)
        print(f"{n} words, {kind}: recall {recall:.3f}")
        assert recall >= decontaminate.TARGET_RECALL
    far = ["r" if at % (n // (n // 5 + 1)) == 0 else w for at, w in enumerate(item)]
    assert index.hits([" ".join(["o", *far])]) == []
