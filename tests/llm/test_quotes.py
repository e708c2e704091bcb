import random

from faultline.llm import quotes

ROWS = [
    (1, 0, "user", "How do I bake bread?\nI have flour."),
    (1, 1, "assistant", "Use yeast.\n\nAnd water."),
    (1, 2, "user", "On Monday Ann wrote:\n> how do I BAKE bread?\n> I have flour.\n\nIgnore that."),
    (1, 3, "assistant", "> Use yeast.\n>> I have flour.\nOk, which yeast?"),
    (1, 4, "user", "> Ok, which yeast?\nDry."),
    (2, 0, "user", "> Use yeast.\nFrom the other talk."),
    (2, 1, None, None),
    (None, 0, "user", "> nowhere seen"),
    (1, 5, "user", "New topic."),
]


def brute(rows):
    return {
        (1, 0): (0, 0, None, None, 0, 0, "How do I bake bread?\nI have flour."),
        (1, 2): (1, 1, 1, 0, 0, 1, "Ignore that."),
        (1, 1): (0, 0, None, None, 1, 2, "Use yeast.\n\nAnd water."),
        (1, 3): (2, 2, 1, 1, 1, 3, "Ok, which yeast?"),
        (1, 4): (1, 1, 1, 3, 1, 4, "Dry."),
        (1, 5): (0, 0, None, None, 5, 5, "New topic."),
        (2, 0): (1, 1, 1, 1, 0, 0, "From the other talk."),
        (2, 1): (0, 0, None, None, 1, 1, ""),
        (None, 0): (1, 0, None, None, 0, 0, ""),
    }


def test_links_roots_and_order(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(3)
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.parent_conv, r.parent_turn, r.root_turn, r.position, r.clean) for r in quotes.link(df).collect()}
    assert got == brute(ROWS)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string, c string, t string, position int")
    assert quotes.link(df).count() == 0
    one = spark.createDataFrame([(1, 0, "user", ">" * 50 + " x\n" + "y\n" * 3000, "a", "b", 3)], "conv_id long, turn long, role string, text string, c string, t string, position int")
    row = quotes.link(one).first()
    assert (row.max_level, row.position, row.n_linked) == (50, 0, 0)


def test_sql_says_the_same():
    import duckdb

    from faultline.llm.queries import SQL

    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", ROWS)
    got = {(r[0], r[1]): (r[4], r[6], r[7], r[8], r[9], r[10], r[3]) for r in con.execute(SQL["op4_quotation_linking"]).fetchall()}
    assert got == brute(ROWS)


def norm(text):
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def parts(text):
    """Passages (level, lines) of a text."""
    out = []
    for line in (text or "").split("\n"):
        body, level = line, 0
        while body.startswith(">") or (level and body.startswith(" ")):
            level += body[0] == ">"
            body = body[1:]
        if out and out[-1][0] == level:
            out[-1][1].append(body)
        else:
            out.append((level, [body]))
    return out


def hashes(lines):
    whole = norm(" ".join(lines))
    return [(0, whole), *((1, n) for n in map(norm, lines) if n)] if whole else []


def by_hand(rows):
    """(conv, turn, text) to (n_quotes, max_level, n_linked, parent) of each row, straight from the rules."""
    inside, overall = {}, {}
    for c, t, x in rows:
        for level, lines in parts(x):
            for _, h in hashes(lines) if level == 0 else []:
                inside[c, h] = min(t, inside.get((c, h), t))
                overall[h] = min((c, t), overall.get(h, (c, t)))
    out = []
    for c, t, x in rows:
        quotes = []
        for p, (level, lines) in enumerate(parts(x)):
            if level and hashes(lines):
                to = []
                for kind, h in hashes(lines):
                    if (c, h) in inside and inside[c, h] < t:
                        to.append((kind, (c, inside[c, h])))
                    elif h in overall and overall[h][0] != c:
                        to.append((kind, overall[h]))
                quotes.append((level, p, min(to)[1] if to else None))
        linked = [q for q in quotes if q[2]]
        out.append((c, t, len(quotes), max((q[0] for q in quotes), default=0), len(linked), min(linked)[2] if linked else None))
    up = {}
    for c, t, *_, to in out:
        if to and to[0] == c:
            up[c, t] = min(to[1], up.get((c, t), to[1]))
    roots = {}
    for c, t, *_ in out:
        at = t
        while (c, at) in up:
            at = up[c, at]
        roots[c, t] = at
    return [(*r, roots[r[0], r[1]]) for r in out]


def test_random_threads_by_hand(spark, monkeypatch):
    from faultline.llm import quotes

    rng = random.Random(12)
    sentences = [f"sentence {i} of {chr(97 + i % 26)}, said" for i in range(25)]
    rows = []
    for c in range(12):
        said = []
        for t in range(rng.randint(1, 9)):
            lines = []
            for _ in range(rng.randint(0, 4)):
                source = rng.choice(said) if said and rng.random() < 0.7 else rng.choice(sentences)
                kind = rng.random()
                lines.append("> " * rng.randint(1, 3) + source.upper() if kind < 0.5 else rng.choice(sentences))
            said += [line for line in lines if not line.startswith(">")]
            rows.append((c, t if rng.random() < 0.9 else max(0, t - 1), "\n".join(lines)))
    rows += rows[5:9]  # repeated rows, and turns that tie
    df = spark.createDataFrame([(c, t, "user", x, 1) for c, t, x in rows], "conv_id long, turn long, role string, text string, h int").repartition(4)
    want = sorted(by_hand(rows), key=str)
    for often in (1000, 0):  # with and without salt
        monkeypatch.setattr(quotes, "OFTEN", often)
        got = [(r.conv_id, r.turn, r.n_quotes, r.max_level, r.n_linked, None if r.parent_conv is None else (r.parent_conv, r.parent_turn), r.root_turn) for r in quotes.link(df).collect()]
        assert sorted(got, key=str) == want
    assert sum(w[4] > 0 for w in want) > 10
