"""Chat formatting against Viterbi over the whole conversation, and against enumeration."""

import itertools
from collections import Counter

import numpy as np

from pagemill.llm import chat

TURNS = [("system", "Be brief."), ("user", "Hello?\nAre you there?"), ("assistant", "Yes. " * 60 + "\n\nMore."), (None, "And now?"), ("assistant", "x\nUser: y?\nAssistant: z"), ("Human", "### User: hi"), ("narrator", "Well."), ("gpt", None), ("", ""), ("user", "AI: tell me")]
COLUMNS = "conv_id long, turn long, role string, text string, part int, pos string, rendered int"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], COLUMNS).repartition(3)


def fitted():
    turns = Counter({("", "system"): 3, ("", "user"): 5, ("system", "user"): 3, ("user", "assistant"): 40, ("assistant", "user"): 30})
    lines = Counter({("system", 0): 5, ("user", 0): 30, ("user", 1): 25, ("assistant", 0): 40, ("assistant", 2): 30, ("assistant", 4): 9})
    return chat.Model(turns, lines)


def test_viterbi_finds_the_best_of_all_paths():
    model, rows = fitted(), [(1, k, r, t) for k, (r, t) in enumerate(TURNS[:5])]
    emitted = list(chat.emissions(model, rows))[:6]
    best = max(itertools.product(range(6), repeat=len(emitted)), key=lambda p: model.first[p[0]] + sum(model.step[a, b] for a, b in zip(p, p[1:])) + sum(e[s] for e, s in zip(emitted, p)))
    cut = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hello?\nAre you there?"), (1, 2, "assistant", "Yes. " * 60 + "\n\nMore.")]
    assert [s for states in chat.decode(model, cut, None, None) for s in states] == list(best)


def test_decoding_in_parts_is_decoding_the_whole():
    model = fitted()
    draw = np.random.default_rng(4)
    for _ in range(30):
        rows = [(1, k, *TURNS[draw.integers(len(TURNS))]) for k in range(12)]
        whole = chat.decode(model, rows, None, None)
        a, b = sorted(draw.integers(1, 12, 2).tolist())
        if a == b:
            continue
        before = [None, chat.start_scores(model, rows[:a]), chat.start_scores(model, rows[:b])]
        after = [chat.matrix(model, rows[a:]).max(axis=1), chat.matrix(model, rows[b:]).max(axis=1), None]
        parts = [rows[:a], rows[a:b], rows[b:]]
        assert [s for p, x, y in zip(parts, before, after) for s in chat.decode(model, p, x, y)] == whole


def test_roles_are_recovered_and_texts_kept(spark):
    rows = [(c, t, *turn) for c in (1, 2, None) for t, turn in enumerate(TURNS)]
    rows += [(3, t, ("user", "assistant")[t % 2], f"line {t}\nnext?") for t in range(400)]  # one long conversation
    rows += [(4, 0, "user", "x" * 300_000), (4, 1, "assistant", "y\n" * 20_000)]
    rows += [(5, 0, "user", "again?")] * 30  # repeats are turns of their own
    found = chat.format_chats(table_of(spark, rows)).collect()
    by_turn = {}
    for r in sorted(found, key=lambda r: r.piece):
        by_turn.setdefault((r.conv_id, r.turn), []).append(r)
        assert r.rendered == f"<|im_start|>{r.role}\n{r.text}<|im_end|>\n"
    assert len(by_turn) == len({r[:2] for r in rows}) and [r.text for r in by_turn[5, 0]] == ["again?"] * 30
    roles = lambda c, t: [r.role for r in by_turn[c, t]]
    for c in (1, 2, None):
        assert [roles(c, t)[0] for t in range(10)] == ["system", "user", "assistant", "user", "assistant", "user", roles(c, 6)[0], "assistant", roles(c, 8)[0], "user"]
        assert roles(c, 4) == ["assistant", "user", "assistant"] and [r.text for r in by_turn[c, 4]] == ["x", "y?", "z"]
        assert by_turn[c, 5][0].text == "hi" and by_turn[c, 7][0].text == ""
        assert by_turn[c, 2][0].text == TURNS[2][1]
    assert all(roles(3, t) == [("user", "assistant")[t % 2]] for t in range(400))


def plain_model(rows):
    """Counts over the conversations in order, without parts."""
    turns, lines, last = Counter(), Counter(), ("none", None)
    for conv, _, role, text in rows:
        who = chat.NAMED.get((role or "").strip().lower())
        before = last[1] if last[0] == (conv,) else ""
        if who:
            if before is not None:
                turns[before, who] += 1
            for line in (text or "").split("\n"):
                bare = line.strip()
                lines[who, bare.endswith("?") + 2 * (len(bare) > 200) + 4 * (not bare)] += 1
        last = ((conv,), who)
    return turns, lines


def plain_roles(model, rows):
    """Each turn's recovered roles and texts, by Viterbi over whole conversations, one state at a time."""
    out = []
    for _, own in itertools.groupby(rows, key=lambda r: r[0]):
        own, best = list(own), None
        for _, turn, role, text in own:
            for k, (marker, cut, line) in enumerate(chat.lines_of(role, text)):
                emitted = model.emit(marker, line, k == 0)
                ways = {}
                for s in range(6):
                    came = [(model.first[s], ())] if best is None else [(score + model.step[p, s], path) for p, (score, path) in best.items()]
                    score, path = max(came, key=lambda c: c[0])
                    ways[s] = (score + emitted[s], (path, (turn, marker, cut, line, s)))
                best = ways
        path, steps = max(best.values(), key=lambda w: w[0])[1], []
        while path:
            path, step = path
            steps.append(step)
        for turn, marker, cut, line, s in reversed(steps):
            if s < 3:
                out.append([own[0][0], turn, chat.ROLES[s], line[cut:] if marker == chat.ROLES[s] else line])
            else:
                out[-1][3] += "\n" + line
    return Counter(map(tuple, out))


def test_any_number_of_parts_gives_the_model_and_turns_of_plain_viterbi(spark, monkeypatch):
    draw = np.random.default_rng(9)
    rows = [(c, t, *TURNS[draw.integers(len(TURNS))]) for c in (None, 1, 2, 3) for t in range(20)]
    rows += [(7, t, *TURNS[[1, 4, 6, 0, 8][draw.integers(5)]]) for t in range(150)] + [(9, 0, "user", "one?")]  # one conversation across borders
    found = {}
    for n in (1, 8, 64):
        monkeypatch.setattr(chat, "PART_BYTES", sum(len(r[3] or "") + 64 for r in rows) // n + 1)
        turns = chat.ordered(table_of(spark, rows).repartition(n), "conv_id", "turn", "role", "text")
        assert n == 1 or turns.select("part").distinct().count() > n / 2
        model = chat.learn(turns)
        plain = chat.Model(*plain_model(sorted(rows, key=lambda r: (r[0] or 0, r[1]))))
        assert np.array_equal(model.first, plain.first) and np.array_equal(model.step, plain.step) and np.array_equal(model.feature, plain.feature)
        found[n] = Counter((r.conv_id, r.turn, r.role, r.text) for r in chat.format_chats(table_of(spark, rows).repartition(n)).collect())
    assert found[1] == found[8] == found[64] == plain_roles(plain, sorted(rows, key=lambda r: (r[0] or 0, r[1])))


def test_rendered_output_and_other_markers_are_read_back(spark):
    said = [("system", "Be brief."), ("user", "Hello?\nAgain"), ("assistant", "Yes.\n"), ("user", ""), ("assistant", "end")]
    rows = [(1, 0, None, "".join(chat.rendered(*s) for s in said).rstrip("\n"))]
    rows += [(2, 0, None, "<|user|> hi\n<|assistant|>\nyes"), (3, 0, None, "### Human\nhi\n### Assistant\nyes"), (4, 0, None, "[user] hi\n[assistant]: yes"), (5, 0, None, "Q: hi\nA: yes")]
    rows += [(10 + c, t, ("user", "assistant")[t % 2], ("what is it?", "an answer")[t % 2]) for c in range(20) for t in range(6)]
    found = {}
    for r in sorted(chat.format_chats(table_of(spark, rows)).where("conv_id < 10").collect(), key=lambda r: r.piece):
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    assert found[1] == said
    assert all([(r, t.strip()) for r, t in found[c]] == [("user", "hi"), ("assistant", "yes")] for c in (2, 3, 4, 5))


def test_markers_are_not_needed_for_every_turn(spark):
    known = [(c, t, ("user", "assistant")[t % 2], ("what is it?", "an answer " * 30)[t % 2]) for c in range(30) for t in range(6)]
    bare = [(c, t, None, x) for c, t, _, x in known if c >= 28]
    found = chat.format_chats(table_of(spark, known[: 28 * 6] + bare)).where("conv_id >= 28").collect()
    assert {(r.conv_id, r.turn, r.role) for r in found} == {(c, t, r) for c, t, r, _ in known if c >= 28}


def test_empty_table(spark):
    assert chat.format_chats(table_of(spark, [])).count() == 0
