"""Role repair against a programme over explicit choices; chunks; edge rows."""

import random

from ledgerlens.llm import chat

COLUMNS = "conv_id long, turn long, role string, text string"


def least_cost(codes):
    """(cost, turns) of the cheapest repair, one row and one choice at a time."""
    legal = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}

    def inserted(states):
        best = dict(states)
        for _ in range(4):
            for s, (c, t) in list(best.items()):
                for r in legal[s]:
                    best[r] = min(best.get(r, (1 << 30, 0)), (c + 2, t + 1))
        return best
    states = {0: (0, 0)}
    for o in codes:
        new = {}
        for s, (c, t) in states.items():
            if s:
                new[s] = min(new.get(s, (1 << 30, 0)), (c + (1 if o in (0, s) else 4), t))
        for s, (c, t) in inserted(states).items():
            for r in legal[s]:
                new[r] = min(new.get(r, (1 << 30, 0)), (c + (0 if r == o else 3 if o else 1), t + 1))
        states = new
    return inserted(states)[3]


def price(pieces, codes):
    cost = 0
    for _, row, role, _, action, _ in pieces:
        code = chat.ROLES.index(role) + 1
        if action == "insert":
            cost += 2
        elif action == "merge":
            cost += 1 if codes[row] in (0, code) else 4
        elif action == "relabel":
            cost += 3 if codes[row] else 1
    return cost


def is_legal(roles):
    body = roles[1:] if roles[:1] == ["system"] else roles
    return len(body) % 2 == 0 and len(body) > 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def test_any_cut_gives_the_least_cost():
    rng = random.Random(3)
    for _ in range(3000):
        codes = bytes(rng.choice([0, 1, 2, 3, 2, 3]) for _ in range(rng.randint(1, 10)))
        at = sorted(rng.sample(range(1, len(codes)), min(len(codes) - 1, rng.randint(0, 3))))
        parts = [codes[a:b] for a, b in zip([0, *at], [*at, len(codes)])]
        found = chat.cuts([chat.matrix(p) for p in parts])
        pieces, before = [], 0
        for k, (p, c) in enumerate(zip(parts, found)):
            pieces += chat._pieces(p, [(0, "t")] * len(p), *c, before, k == len(parts) - 1)
            before += len(p)
        turns = {p[0]: p[2] for p in reversed(pieces)}
        assert sorted(turns) == list(range(len(turns))) and is_legal([turns[i] for i in sorted(turns)])
        assert (price(pieces, codes), len(turns)) == least_cost(codes), codes


def render(rows):
    return "".join(r.rendered for r in sorted(rows, key=lambda r: (r.seq, r.row_no)))


def test_rendering(llm):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", "there"), (1, 2, "assistant", "yes <|end|>"), (2, 0, "assistant", "a"),
            (3, 0, "system", "s"), (3, 1, "User ", "u")]
    out = chat.repair(llm.createDataFrame(rows, COLUMNS)).collect()
    by = lambda c: [r for r in out if r.conv_id == c]
    assert render(by(1)) == "<|user|>\nhi\n\nthere<|end|>\n<|assistant|>\nyes < |end|><|end|>\n"
    assert render(by(2)) == "<|user|>\n<|end|>\n<|assistant|>\na<|end|>\n"
    assert render(by(3)) == "<|system|>\ns<|end|>\n<|user|>\nu<|end|>\n<|assistant|>\n<|end|>\n"


def test_long_conversations_in_chunks(llm, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(chat, "LIMIT", 100)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "tool", None]), f"t{rng.randint(0, 9)}")
            for t in range(2500)]
    rows += [(2, 7, rng.choice(["user", "assistant"]), f"x{i}") for i in range(900)]  # ties: one turn number
    rows += [(3, None, "user", f"y{i}") for i in range(300)]
    out = chat.repair(llm.createDataFrame(rows, COLUMNS)).collect()
    for c in (1, 2, 3):
        own = sorted((r for r in out if r.conv_id == c), key=lambda r: (r.seq, r.row_no))
        given = {r for r in rows if r[0] == c}
        assert [r.row_no for r in own if r.action != "insert"] == list(range(len(given)))
        roles = {}
        for r in own:
            assert roles.setdefault(r.seq, r.role) == r.role
        assert sorted(roles) == list(range(len(roles))) and is_legal([roles[i] for i in sorted(roles)])
        assert render(own).count("<|end|>") == len(roles)
    ordered = sorted((r for r in rows if r[0] == 1), key=lambda r: r[1])
    codes = bytes((chat.ROLES.index(r[2]) + 1) if r[2] in chat.ROLES else 0 for r in ordered)
    own = [r for r in out if r.conv_id == 1]
    pieces = [(r.seq, r.row_no, r.role, None, r.action, "") for r in own]
    assert (price(pieces, codes), len({r.seq for r in own})) == least_cost(codes)


def test_edge_rows(llm):
    rows = [(None, 1, "user", "a", 1), (None, 2, "assistant", None, 2), (1, 1, None, "b", 3), (1, 1, None, "b", 4),
            (2, 1, "user", "x" * 200_000, 5), (2, 2, "assistant", "", 6), (3, None, "assistant", "c", 7)]
    df = llm.createDataFrame(rows, COLUMNS + ", seq int").withColumnRenamed("seq", "block")
    out = chat.repair(df)
    assert out.columns == ["conv_id", "seq", "row_no", "role", "source_turn", "action", "rendered"]
    got = {}
    for r in out.collect():
        got.setdefault(r.conv_id, []).append(r)
    assert render(got[None]) == "<|user|>\na<|end|>\n<|assistant|>\n<|end|>\n"
    assert [r.action for r in sorted(got[1], key=lambda r: r.seq)] == ["relabel", "insert"]
    assert len(got[2][0].rendered) > 200_000 or len(got[2][1].rendered) > 200_000
    assert chat.repair(df.limit(0)).count() == 0
