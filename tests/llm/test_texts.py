import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryloom.llm import boilerplate, encoding, markup, splitting

CHUNK = "id string, filename string, heading string, content string, chunk_type string, loaded_at timestamp"


def chunks(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], CHUNK).selectExpr("*", "'x' as field", "'y' as markup", "1 as line_no", "'z' as boundary", "'h' as host")


@pytest.mark.parametrize(("text", "kinds"), [
    ("a <b>bold</b>", {"html"}), ("x &amp;lt;y&amp;gt;", {"html"}), ("<!-- Data Table -->\na,b", set()), ("<!-- note -->", {"html"}), ("List<Thing> and a < b and b > c", set()), ("R&D with 2 * 3 * 4", set()),
    ("*one* word", {"markdown"}), ("snake_case_name __x and y", set()), ("~~gone~~", {"markdown"}), ("[a](b)", {"markdown"}), ("![a](b.png)", {"markdown"}), ("[a][b]\n\n[b]: /x", {"markdown"}), ("### Head", {"markdown"}),
    ("Title\n-----\nx", {"markdown"}), ("- item\n1. item\n| a | b |\n|---|---|", set()), ("[[Link|l]]", {"wiki"}), ("[https://a.b c]", {"wiki"}), ("{{Note|a=1}}", {"wiki"}), ("''i'' and '''b'''", {"wiki"}), ("== H ==", {"wiki"}),
    ("{|\n|-\n| a || b\n|}", {"wiki"}), ("it''s don't", set()), ("\\textbf{x}", {"latex"}), ("$x_i$ and $5 for one and $6", {"latex"}), ("costs $5 and $6", set()), ("C:\\new\\temp", set()), ("\\begin{itemize}\n\\item a\n\\end{itemize}", {"latex"}),
    ("`**a** <b>` and\n```\n# x\n<b>\n```", set()), ("See note [12] and C#", set()), ("", set()), (None, set())])
def test_markup_kinds(text, kinds):
    assert {t[2] for t in markup.scan(text)} == kinds


def test_clean_text_keeps_structure():
    t = "<h2>Head</h2>\n<ul><li>a</li><li><b>b</b></li></ul>\n== W ==\n\\section{S}\n\\(x+1\\) and $$y$$\n`**code**`\n```\n<b>\n```\n[l](u) ''i'' &amp;lt;"
    out = markup.clean_text(t)
    for part in ("## Head", "- a", "- b", "## W", "# S", "$x+1$", "$y$", "`**code**`", "```\n<b>\n```", "l i <"):
        assert part in out
    assert {x[2:4] for x in markup.scan(out)} <= {("markdown", "heading"), ("latex", "formula")}
    assert markup.clean_text(None) is None and markup.clean_text("plain *") == "plain *"


def brute_match(a, b):
    ka, kb = ([[i for i, p in enumerate(t[0]) if p == n] for n in range(len(t[0]))] for t in (a, b))

    def size(x, y):
        if a[1][x] != b[1][y]:
            return 0
        m = [[0] * (len(kb[y]) + 1) for _ in range(len(ka[x]) + 1)]
        for i, u in enumerate(ka[x], 1):
            for j, v in enumerate(kb[y], 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + size(u, v))
        return 1 + m[-1][-1]

    return size(0, 0)


def test_tree_matching_is_maximal():
    rng = random.Random(3)
    for _ in range(60):
        trees = []
        for _ in range(2):
            n = rng.randint(1, 9)
            trees.append(([-1, *(rng.randrange(i) for i in range(1, n))], ["r", *(rng.choice("ab") for _ in range(n - 1))]))
        order = []
        for t in trees:  # preorder
            kids = [[i for i, p in enumerate(t[0]) if p == n] for n in range(len(t[0]))]
            seq, todo = [], [0]
            while todo:
                x = todo.pop()
                seq.append(x)
                todo.extend(reversed(kids[x]))
            at = {x: k for k, x in enumerate(seq)}
            order.append(([at[t[0][x]] if t[0][x] >= 0 else -1 for x in seq], [t[1][x] for x in seq]))
        assert len(markup.match_trees(*order)) == brute_match(*order)


@pytest.mark.parametrize(("text", "kinds"), [
    ("$$" + "x + y " * 1000 + "$$", {"latex"}), ("<!-- " + "c" * 30000 + " -->", {"html"}), ("**" + "a b " * 1500 + "c**", {"markdown"}), ("`" + "<b>x</b> " * 700 + "`", set()), ("Title\n--", {"markdown"}),
    ("''" + "a b " * 1500 + "c''", {"wiki"}), ("_" + "a b " * 1500 + "c_", {"markdown"}), ("\\[ never closed " * 50, set())])
def test_spans_of_any_length(text, kinds):
    assert {t[2] for t in markup.scan(text)} == kinds


def test_wrapper_finds_the_template_of_a_host(spark):
    nav = '<nav class="top"><a href="/h">Home</a></nav>\n'
    rows = [(f"i{k}", "host/a", None, nav + f"<p>Text number {k} of its own</p>", "heading") for k in range(12)] + [("n", None, "<b>h</b>", None, None), ("e", "host/b", "", "", "heading")]
    df = chunks(spark, rows)
    w = {(r.id, r.field): r for r in markup.wrapped(df).collect()}
    assert all(len(w[f"i{k}", "content"].template) >= 2 for k in range(12)) and w["n", "heading"].template == []
    clean = {r.id: r for r in markup.cleaned_chunks(df).collect()}
    assert clean["i3"].content == "Text number 3 of its own" and clean["n"].heading == "h" and clean["e"].content == "" and len(clean) == 14
    assert {(r.id, r.field, r.markup) for r in markup.markup_kinds(df.unionByName(df)).collect()} == {(f"i{k}", "content", "html") for k in range(12)} | {("n", "heading", "html")}
    assert markup.markup_kinds(df.limit(0)).count() == 0


def test_long_lists_match_as_short_ones(monkeypatch):
    rng = random.Random(5)
    for _ in range(40):
        pair = []
        for _ in range(2):
            text = "".join(rng.choice(["<p>x</p>", "<div><p>x</p><b>y</b></div>", "<div><ul><li>a<li>b</ul></div>", "<b>", "</b>", "z ", "<br>"]) for _ in range(rng.randint(1, 25)))
            pair.append(markup.flatten(markup.tree(text, markup.scan(text)))[:2])
        monkeypatch.setattr(markup, "_FEW_PAIRS", 2048)
        short = markup.match_trees(*pair)
        monkeypatch.setattr(markup, "_FEW_PAIRS", 0)
        assert markup.match_trees(*pair) == short and len(short) == (brute_match(*pair))
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    tree = markup.flatten(markup.tree(deep, markup.scan(deep)))[:2]
    assert len(markup.match_trees(tree, tree)) == 3002


def test_wrapper_finds_templates_outside_the_commonest_shapes(spark):
    def page(k):
        return "<footer><small>All rights reserved</small></footer>" + f"<blockquote>Said number {k}</blockquote>" * (k + 1)

    def long(k):
        return '<nav class="top"><a href="/h">Home</a></nav>' + "".join(f"<p>Line {k} {i}</p>" for i in range(110 + k))

    common = ["b", "i", "u", "s", "tt", "em", "q", "kbd", "var"]
    rows = [(f"c{e}{k}", "host/a", None, "".join(f"<{e}>{e} {k} {i}</{e}>" for i in range(3)), None) for e in common for k in range(3)]
    rows += [(f"r{k}", "host/a", None, page(k), None) for k in range(6)] + [(f"l{k}", "other/a", None, long(k), None) for k in range(6)]
    clean = {r.id: r.content for r in markup.cleaned_chunks(chunks(spark, rows)).collect()}
    assert all("rights" not in clean[f"r{k}"] and clean[f"r{k}"].count(f"Said number {k}") == k + 1 for k in range(6))
    assert all("Home" not in clean[f"l{k}"] and clean[f"l{k}"].count(f"Line {k} ") == 110 + k for k in range(6))


def test_wrapper_votes_over_all_pairs_of_shapes(spark, monkeypatch):
    rng = random.Random(7)
    parts = ['<nav><a href="/h">Home</a></nav>', "<p>own {}</p>", "<ul><li>a<li>{}</ul>", "<b>same</b>", "**bold** text ", "<i>{}</i>", "<footer><b>end</b></footer>"]
    texts = ["".join(p.format(rng.randrange(3)) for p in parts if rng.random() < 0.6) for _ in range(60)]
    pages = {}
    for k, t in enumerate(texts):
        if tokens := markup.scan(t):
            pages[f"i{k}"] = markup.flatten(markup.tree(t, tokens))
    wanted = {}
    by_shape = {}
    for i, (parents, labels, _) in pages.items():
        by_shape.setdefault((tuple(parents), tuple(labels)), []).append(i)
    number = {s: markup.xxhash.xxh64_intdigest(f"{list(s[0])}{list(s[1])}") - (1 << 63) for s in by_shape}
    for mine, ids in by_shape.items():
        votes = {}
        for theirs, others in by_shape.items():
            a, b = markup.Counter(mine[1]), markup.Counter(theirs[1])
            common = 2 * sum((a & b).values()) / (len(mine[1]) + len(theirs[1]))
            pairs = markup.match_trees(mine, theirs) if number[mine] <= number[theirs] else [(x, y) for y, x in markup.match_trees(theirs, mine)]
            for least in ("own", *markup.NEAR):
                if theirs == mine if least == "own" else common >= least:
                    for x, y in pairs:
                        votes.setdefault((least, x), markup.Counter()).update(pages[o][2][y] for o in others)
        for i in ids:
            wanted[i] = [x for x in range(1, len(mine[0])) if any(c.total() >= 5 and c[pages[i][2][x]] >= 0.6 * c.total() for least in ("own", *markup.NEAR) if (c := votes.get((least, x))))]
    df = chunks(spark, [(f"i{k}", "host/a", None, t, None) for k, t in enumerate(texts)])
    for size in (4096, 12):
        monkeypatch.setattr(markup, "BLOCK_NODES", size)
        assert {r.id: r.template for r in markup.wrapped(df).collect()} == wanted


@pytest.fixture(scope="module")
def model(spark):
    """Border and words of a corpus of pages with menus, consent notices and text, in which no checked line stands as it is."""
    notice = "We use cookies to {} on {}.\nAccept all\nReject"
    menu = "Docs | Home | API | Blog\nSearch"
    said = ["The worker sets a session token that expires after {} seconds, so the cache closes.", "If the option of the table fails, open the page of the entry and wait {} minutes.", "The reducer follows the heading and limits how many entries it may hold to {}."]
    rows = []
    for k in range(120):
        body = "\n\n".join(s.format(k) for s in said)
        top = notice.format(("measure traffic", "improve your visit", "remember you")[k % 3], f"Site{k % 7}") if k % 2 else menu
        rows.append((f"i{k}", "f", None, f"{top}\n\n{body}\n\nEdit this page\n© 2021 Other Works. All rights reserved.", None))
    return boilerplate.learn(chunks(spark, rows))


@pytest.mark.parametrize(("text", "lines"), [
    ("Menu\nHome | Docs | API\n\nThe cache closes before the worker starts, so it waits.", [1, 2]),
    ("We use cookies to measure traffic on Velmora.\nAccept all\nThe token sets a session cookie that expires after 5 seconds.", [1, 2]),
    ("On this page:\n- Some title\n- Other title\n\n- The value of the option limits how many entries it may hold", [1, 2, 3]),
    ('<nav class="top">\n<a href="/a">A</a>\n</nav>\nText that is long enough to be a sentence of the page.', [1, 2, 3]),
    ("Reducer title\n---------\nText that follows the heading here.\n\n| a | b |\n|---|---|", []), ("```\nMenu\n```\n<!-- Data Table -->\nHome,Docs", []),
    ("© 2020 Some Works. All rights reserved.\nv9.1 ▾\n« Previous page\n★★★ 5 votes\nSearch Docs ...", [1, 2, 3, 4, 5]), ("", []), (None, []), (" \n\n", [])])
def test_furniture_lines(text, lines, model):
    assert boilerplate.furniture_lines(text, model) == lines


def test_furniture_operator(spark):
    df = chunks(spark, [("a", "f", None, "Menu\r\nThe page is about the cache and its many workers.", None), ("b", "f", None, None, None), (None, None, None, "", None)])
    assert {tuple(r) for r in boilerplate.furniture(df.unionByName(df)).collect()} == {("a", 1)}
    assert {r.id: r.content for r in boilerplate.main_text(df).collect()}["a"] == "The page is about the cache and its many workers."
    assert boilerplate.furniture(df.limit(0)).count() == 0


def test_smoothing_and_threshold():
    assert abs(sum(boilerplate.smooth([1.0] * 5)) - 5) < 1e-9
    low, high, none = (np.bincount(x, minlength=boilerplate.STEPS) for x in ([5, 6, 7, 60], [60, 61, 70, 6], []))
    step = boilerplate._TOP / boilerplate.STEPS
    assert 8 * step < boilerplate.threshold(low, high) < 60 * step
    assert boilerplate.threshold(none, high) == 0 and boilerplate.threshold(low, none) == boilerplate._TOP == boilerplate.threshold(low, none)
    assert boilerplate.smooth([3.0]) == [3.0]


def test_the_region_step_decides(spark):
    """Without smoothing and border, other lines come out."""
    import dataclasses

    df = chunks(spark, [("a", "f", None, "Menu\n\nThe page is about the cache and its many workers.", None)])
    m = boilerplate.learn(df)
    text = "Menu\n\nThe page is about the cache and its many workers."
    assert boilerplate.furniture_lines(text, m) == [1]
    assert boilerplate.furniture_lines(text, dataclasses.replace(m, border=0.0)) == [] and boilerplate.furniture_lines(text, dataclasses.replace(m, border=9.0)) == [1, 3]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["word", "end.", "why?", "\n", "\n\n", "  ", "```\n", "é"]), max_size=400), st.integers(3, 30))
def test_pieces_rebuild_the_text(parts, limit):
    text, overlap = " ".join(parts), limit // 3
    _, pieces = splitting.split_text(text, limit, overlap)
    assert "".join(p[own - start :] for p, _, start, own in pieces) == text
    assert all(n == len(p.split()) <= limit for p, n, _, _ in pieces)
    for (a, n, _, _), (b, _, _, _) in zip(pieces, pieces[1:], strict=False):
        k = min(n, overlap)
        assert k == 0 or a.split()[-k:] == b.split()[:k]


def test_boundaries_and_operator(spark):
    s = "one two three four five. "
    cases = {"paragraph": ("w " * 300 + "\n\n") * 3, "line": ("w " * 300 + "\n") * 3, "sentence": s * 200, "word": "w " * 1200, "fence": "```\n" + ("w " * 100 + "\n\n") * 6 + "```"}
    want = {"paragraph": "paragraph", "line": "line", "sentence": "sentence", "word": "word", "fence": "line"}
    df = chunks(spark, [(k, "f", None, v, "example") for k, v in cases.items()] + [("short", "f", None, "w " * 500, None), ("none", None, None, None, None), ("empty", None, None, "", None)])
    assert {r.id: r.boundary for r in splitting.oversized_boundaries(df.unionByName(df)).collect()} == want
    pieces = splitting.split_oversized(df).where("id = 'word'").orderBy("piece").collect()
    assert [p.tokens for p in pieces][1:-1] == [p.tokens for p in pieces][1:-1] and all(p.tokens <= 500 and p.n_pieces == len(pieces) for p in pieces)
    with pytest.raises(ValueError):
        splitting.split_oversized(df, 10, 10)
    assert splitting.split_oversized(df.limit(0)).count() == 0


def test_weakest_boundaries_merge_first():
    assert splitting.merge([2, 2, 2, 2], [0, 3, 0, 3], 4) == [(0, 1), (2, 3)]
    assert splitting.merge([5], [0], 3) == [(0, 0)] and splitting.merge([1, 1, 1], [0, 1, 2], 100) == [(0, 2)]


def test_encoding_chains():
    for w, name in (("größe", "cp1252"), ("Настройка", "cp1251"), ("té", "mac-roman"), ("naïve—", "cp437"), ("przesyłka", "latin-1")):
        bad = encoding.decode_as(w.encode("utf-8"), name)
        assert encoding.ungarble(bad)[0] == w
        assert encoding.garbled_forms(w)[encoding.decode_as(bad.encode("utf-8"), name)].endswith("x2")
    for clean in ("größe", "ATENÇÃO", "Настройка", "так", "├──", "√n", "°C", "“quoted”", "Île"):
        assert encoding.ungarble(clean) is None


@pytest.mark.parametrize("word", ["né", "日本語", "こんにちは", "العربية", "שלום", "देवनागरी", "😀", "한국어", "привет", "ελληνικά"])
@pytest.mark.parametrize("name", ["cp1252", "latin-1", "mac-roman", "cp437", "cp1251"])
def test_any_depth_and_script_is_taken_back(word, name):
    bad = word
    for _ in range(6):
        bad = encoding.decode_as(bad.encode("utf-8"), name)
        assert encoding._WORD.sub(lambda m: (encoding.ungarble(m.group()) or (m.group(),))[0], bad) == word


def test_encoding_operator(spark):
    good = "Größe für żółty Każda może Настройка"
    docs = [(1, good), (2, "GrÃ¶ÃŸe ok"), (3, "Gr��e"), (4, "Ka¿da mo¿e"), (5, "├── a\n│ b √n 5 °C"), (6, None), (7, ""), (8, good), (9, "unseen: naÃ¯ve"), (10, good + " " + "x" * 100_000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'w' as word", "'c' as chain")
    assert {r.doc_id for r in encoding.garbled_documents(df).collect()} == {2, 3, 4, 9}
    out = {r.doc_id: r for r in encoding.restored_documents(df).collect()}
    assert out[2].text == "Größe ok" and out[4].text == "Każda może" and out[3].text == "Größe" and out[9].text == "unseen: naïve" and out[2].unrecovered == 0
    assert encoding.garbled_documents(df.limit(0)).count() == 0
