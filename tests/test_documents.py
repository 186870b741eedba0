import json

from quarryloom.operators import code, markdown, sections, summaries, tables
from quarryloom.plans.pipeline import ingestion_stages, run_stages


def test_cleaning_steps():
    doc = "---\ntitle: Guide\n---\nnav\n\n# 1.2 Guide\nlong enough body text for the threshold\n#### On this page\n- a\n## Next\nshort\n"
    assert markdown.front_matter(doc)[0] == {"title": "Guide"}
    assert "nav" not in markdown.drop_before_h1(doc) and markdown.drop_before_h1(doc).startswith("---")
    assert "- a" not in markdown.drop_furniture_sections(doc)
    assert "short" not in markdown.blank_short_sections(doc)
    assert "# Guide" in markdown.strip_heading_numbers(doc)
    assert markdown.drop_before_h1("no heading") == "no heading"
    assert markdown.fill_empty_h1("# T\n## A\nx\n## B\ny").startswith("# T\n\nFor information about T, see the following:\n\n- A\n- B")
    assert markdown.ensure_h1("---\ntitle: T\n---\nbody").endswith("# T\n\nbody") and markdown.ensure_h1("body") == "body"
    assert markdown.strip_line_numbers("1 a\n```\n12x = 1\n```") == "1 a\n```\nx = 1\n```"
    assert markdown.blank_after_headings("# A\nb") == "# A\n\nb"
    assert markdown.unwrap_comments("// a\n// b\nx\n/// doc") == "// a b\nx\n/// doc"
    assert markdown.drop_short_sections("# A\none two\n## B\none", 2) == "# A\none two"


def test_rules_and_metadata(spark):
    rules = markdown.load_rules("pattern,replacement,flags,priority,comment\nb+,c,I,2,\na,\\0x,,1,\nbroken\n")
    assert [r[0] for r in rules] == ["a", "b+"]
    from pyspark.sql import functions as F

    assert spark.range(1).select(markdown.apply_rules(F.lit("zBBz"), [("b+", "c", "I")])).first()[0] == "zcz"
    merged = markdown.merge_metadata({"title": "A", "tags": "x"}, {"title": "B", "level": "2", "description": "d"})
    assert merged == {"title": "A - B", "tags": "x, level=2", "description": "d"}


def test_code():
    assert code.detect_language('{"a": 1}') == "json" and code.detect_language("<div>x</div>") == "html" and code.detect_language("def f():\n  pass") == "python"
    assert code.annotate_fences('```\n{"a": 1}\n```') == '```json\n{"a": 1}\n```'
    assert json.loads(code.pretty_json('{"a":[1]}')) == {"a": [1]} and code.pretty_json("nope") is None
    py = "x = 1\n# about f\ndef f():\n    pass\n\ndef g():\n    pass"
    assert code.split_code(py, "python") == ["# about f\ndef f():\n    pass", "def g():\n    pass"]
    assert len(code.split_code(py, "python", keep_head=True)) == 3
    assert code.split_code("const f = (a) => {\n}\nfunction g() {\n}", "js")[1] == "function g() {\n}"
    assert "  a: 1" in code.format_fences("```css\nb {\na: 1\n}\n```")


def test_tables():
    pipe = "text\n| a | b |\n|---|---|\n| 1 | x \\| y |\nend"
    (start, end, kind), = tables.table_spans(pipe)
    assert kind == "pipe" and tables.parse_table(pipe[start:end]) == [["a", "b"], ["1", "x | y"]]
    assert tables.pipe_tables_to_csv(pipe) == 'text\n<!-- Data Table -->\na,b\n1,x | y\nend'
    assert tables.html_tables_to_csv("<table><caption>C</caption><tr><th>a</th><th>b</th></tr><tr><td>1</td></tr></table>") == "<!-- Data Table -->\nTable: C\na,b\n1,"
    assert tables.table_spans("```\n| a | b |\n|---|---|\n```") == []
    rows = [[str(i), "w " * 5] for i in range(10)]
    parts = tables.split_rows(["n", "v"], rows, 20)
    assert sum(len(p) for p, _, _ in parts) == 10 and all(n <= 20 for _, n, _ in parts)
    assert [o for _, _, o in tables.split_rows(["n"], [["w " * 50]], 10)] == [True]
    assert abs(tables.split_balanced(["n", "v"], rows, 60)[0][1] - tables.split_balanced(["n", "v"], rows, 60)[1][1]) <= 5
    assert tables.decorate("H", tables.pipe_tables_to_csv(pipe[start:end])).split("\n")[1] == "Table: H (from 1 to 1: 1 rows)"
    moved = tables.move_error_tables("# A\n| Error returned | x |\n|---|---|\n| 1 | 2 |\ntext\n# B\n")
    assert moved.index("text") < moved.index("Error returned") < moved.index("# B")


def test_blocks_hierarchy_and_chunks(spark):
    text = "intro\n# A\na a\n## B\n```\n# not\n```\n### C\nc\n## D\nd\n# A\n"
    df = spark.createDataFrame([("f.md", text), ("g.md", ""), ("h.md", None)], "path string, text string")
    blocks = sections.with_hierarchy(sections.explode_blocks(df)).orderBy("seq").collect()
    assert [b.concat_header_path for b in blocks] == ["A", "A > B", "A > B > C", "A > D", "A"]
    assert [b.parent_seq for b in blocks] == [None, 0, 1, 0, None]
    chunks = sections.build_chunks(df.where("text is not null")).orderBy("pos").collect()
    assert len(chunks) == 5 and chunks[1].parent_id == chunks[0].id
    toks = spark.createDataFrame([("f", i, n, t) for i, (n, t) in enumerate([(1, 5), (2, 3), (3, 2), (2, 1), (1, 7)])], "file string, seq int, level int, tokens bigint")
    assert [(r.end_seq, r.cumulative) for r in sections.subtree_tokens(toks).orderBy("seq").collect()] == [(4, 11), (3, 5), (3, None), (4, None), (None, None)]
    assert [r.places for r in sections.duplicate_headings(sections.with_hierarchy(sections.explode_blocks(df))).collect()] == [[0, 4]]


def test_enforce_size_peels_code_then_tables():
    text = "words " * 5 + "\n\n```python\ndef a():\n    return 1\n\ndef b():\n    return 2\n```\n\n| a | b |\n|---|---|\n| 1 | 2 |\n"
    kinds = [k for k, _, _ in sections.enforce_size("H", text, 6)]
    assert kinds[0] == "heading" and "example" in kinds and "table" in kinds
    assert sections.enforce_size("H", "short", 6) == [("heading", "short", "")]


def test_toc_rebuild_and_report():
    out = sections.headings_from_toc("Getting started\nbody\n## Noise\nSetup\n", [(1, "1. Getting Started"), (2, "1.1 Setup")])
    assert out == "# Getting Started\nbody\nNoise\n## Setup\n"
    assert sections.report_sections("  # A\nx\n#### B\ny", 3) == [(1, "A", "x\ny")]
    assert sections.parse_heading("## X") == ("X", 2) and sections.parse_heading("x") == ("", 999)


def test_pipeline_and_backends(spark):
    docs = spark.createDataFrame([("a.md", "# T\n" + "word " * 60 + ". More.")], "path string, text string")
    r = run_stages(spark, ingestion_stages(), {"documents": docs})
    row = r.tables["chunks"].first()
    assert r.ok and row.chunk_summary and len(row.embedding) == 48
    bad = run_stages(spark, ingestion_stages(backend="none"), {"documents": docs})
    assert not bad.ok and bad.error.startswith("summarise")
    c = spark.createDataFrame([("1", "table", "P", "sum", "a b"), ("2", "heading", "P", "false", None)], "id string, chunk_type string, concat_header_path string, chunk_summary string, content string")
    once = summaries.with_metadata_prefix(summaries.with_table_summary(c))
    assert [x.content for x in once.orderBy("id").collect()] == ["Path: P\r\nsum\na b", "Path: P\r\n"]
    assert summaries.with_metadata_prefix(once).orderBy("id").collect() == once.orderBy("id").collect()
