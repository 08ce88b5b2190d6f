"""The pipeline against plain Python, stage by stage."""

import re
from collections import defaultdict

import corpus_pipeline
from pagemill.llm import decontaminate, langid, tokens
from pagemill.llm.common import table


def plain_stages(rows, items):
    """doc_ids that stay after each stage, by plain Python."""
    letters = [(i, t) for i, t in rows if re.search(r"[^\W\d_]", t or "")]  # each letter has some language
    groups = defaultdict(list)
    for i, t in letters:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i, t))
    unique = sorted((i, t) for _, i, t in (min(g) for g in groups.values()))
    sets = []
    for i, t in unique:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(unique)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    shared = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            shared[x].append(k)
    tried = set()
    for ks in shared.values():
        for a in ks:
            for b in ks:
                if a < b and (a, b) not in tried:
                    tried.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        x, y = sorted((find(a), find(b)))
                        root[y] = x
    apart = [u for k, u in enumerate(unique) if find(k) == k]
    bare = lambda t: [w for w in map(decontaminate.plain, t.split()) if w]
    index = [(w, {x: sum(1 << k for k, y in enumerate(w) if y == x) for x in set(w)}) for w in map(bare, items) if len(w) >= 8]

    def hit(words):
        have = set(words)
        return any(sum(x in have for x in w) >= len(w) - len(w) // 5 and decontaminate.edits(p, len(w), words)[0] <= len(w) // 5 for w, p in index)

    clean = [(i, t) for i, t in apart if not hit(bare(t))]
    return [{i for i, _ in kept} for kept in (letters, unique, apart, clean)]


def test_every_stage_keeps_what_plain_python_keeps(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    languages = {r.doc_id: r.lang_pred for r in langid.language_id(docs).collect()}
    want = plain_stages(rows, [r.text for r in table(spark, sf_dir, "benchmark").collect()])
    kept = docs
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns
        found = kept.select("doc_id", "lang").collect()
        assert {r.doc_id for r in found} == ids, name
        assert all(r.lang == languages[r.doc_id] for r in found)  # the predicted one, from the first stage on
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).collect()
    enc, texts = tokens.Encoder(tokens.default_path()), dict(rows)
    held = defaultdict(int)
    for p in pieces:
        held[p.doc_id] += p.length
    assert held == {i: len(enc.encode([texts[i]])[0]) + 1 for i in want[-1]}
    assert corpus_pipeline.run(spark, sf_dir).count() == len(pieces)


def test_languages_that_are_not_asked_for_go(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    languages = {r.doc_id: r.lang_pred for r in langid.language_id(docs).collect()}
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", ("en", "es"))
    kept = corpus_pipeline.language_id(spark, docs, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.lang for r in kept} == {i: lang for i, lang in languages.items() if lang in ("en", "es")} and len(kept) < len(languages)


def test_a_corpus_without_labels_stays_whole(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "source", "n_chars")
    assert corpus_pipeline.language_id(spark, docs, "/root/testdata/sf0.001").count() == docs.count()


def test_an_empty_table_runs_through(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0


def test_odd_rows_run_through(spark):
    """Nulls, repeats, long texts and columns of other names: a defined result at every stage."""
    text = lambda seed, n: " ".join(f"{seed}{k}" for k in range(n))
    rows = [
        (1, text("a", 60), "en"), (2, text("a", 60).replace(" ", "\n"), None), (3, text("a", 59) + " end", "en"), (4, None, "en"), (5, "", None), (6, "12 ,.", "de"),
        (7, text("b", 40), None), (7, text("b", 40), None), (None, text("c", 40), "fr"), (None, None, None), (8, "word " * 150_000, "en"), (9, "short", "de"),
    ]
    schema = "doc_id long, text string, lang string, digest string, label int, keys string, component_id long, part int, ids string"
    docs = spark.createDataFrame([(*r, None, None, None, None, None, None) for r in rows], schema).repartition(3)
    want = [{1, 2, 3, 7, 8, 9, None}, {1, 3, 7, 8, 9, None}, {1, 7, 8, 9, None}, {1, 7, 8, 9, None}]
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        found = [r.doc_id for r in docs.collect()]
        assert set(found) == ids, name
        assert len(found) == len(ids) + (name == "language_id")
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {1, 7, 8, 9, None}
