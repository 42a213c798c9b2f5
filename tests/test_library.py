"""The library without its subpackage llm."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from quillmill.functions import splitting
from quillmill.functions.register import register
from quillmill.operators import chunking, cleaning, curation, structure
from quillmill.plans import cleaning_sql
from quillmill.plans.noisy import NOISY_SQL, noisy


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id int, text string")


def only(df, *names):
    return [tuple(r) for r in df.orderBy(*df.columns[:2]).select(*names).collect()]


def test_toc_falls_until_a_heading(spark):
    df = texts(spark, "Sommaire\n1.1 Pompes 12\nrest\n# Titre\ncorps", None, "")
    assert only(cleaning.drop_toc(df), "text") == [("# Titre\ncorps",), (None,), ("",)]


def test_marker(spark):
    df = texts(spark, cleaning.cleaning_marker("default") + "body")
    assert only(cleaning.strip_marker(df), "text") == [("body",)]


def test_sections_have_paths(spark):
    df = texts(spark, "# A\nx\n## B\ny\n### C\n## D\n# E\nz")
    assert only(structure.sections(df), "start_line", "end_line", "path") == [(0, 1, ["A"]), (2, 3, ["A", "B"]), (4, 4, ["A", "B", "C"]), (5, 5, ["A", "D"]), (6, 7, ["E"])]


def test_splitter_bounds_and_covers():
    rng = random.Random(0)
    for _ in range(200):
        text = "".join(rng.choice(["word ", "x", ". ", "\n", "\n\n", "\n## "]) for _ in range(rng.randrange(400)))
        chunks = list(chunking.split_text(text, 80, 20))
        assert all(0 < len(c) <= 80 and c in text for c in chunks)
        assert set("".join(chunks)) >= set("".join(text.split()))


def test_merging_pairs_small_chunks(spark):
    df = spark.createDataFrame([(1, i, "a" * n, "s", i) for i, n in enumerate((10, 10, 10, 500, 10))], "doc_id int, chunk_index int, content string, section_title string, other int")
    assert only(curation.merge_chunks(df), "merged_from", "other", "chunk_size") == [([0, 1], 0, 22), ([2, 3], 2, 512), (None, 4, 10)]


def test_merging_loses_and_repeats_nothing(spark):
    rng = random.Random(3)
    data = [(d, i, rng.choice("xyz") * rng.choice((10, 100, 399, 400, 1999, 2500)), rng.choice(("a", "b", None))) for d in range(20) for i in range(rng.randrange(1, 12))]
    df = spark.createDataFrame(data, "doc_id int, chunk_index int, content string, section_hierarchy_string string")
    for strategy in ("sequential", "semantic", "hybrid"):
        got = curation.merge_chunks(df, strategy=strategy).collect()
        seen = sorted((r.doc_id, i) for r in got for i in r.merged_from or [r.chunk_index])
        assert seen == sorted((d, i) for d, i, *_ in data)
        assert all(len(r.content) <= 2000 for r in got if r.merged)


@pytest.mark.parametrize("name", [*cleaning_sql.STEPS])
def test_cleaning_rules_change_the_noisy_documents(name):
    """The rules' queries are compared with SQL over these documents; that says something only where a rule applies."""
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    changed = f"SELECT count(*) FROM ({cleaning_sql.chain_sql(name, 'noisy', NOISY_SQL)}) c JOIN (WITH {NOISY_SQL} SELECT * FROM noisy) n ON c.doc_id = n.doc_id WHERE c.text IS DISTINCT FROM n.text"
    assert con.execute(changed).fetchone()[0] > 0


def test_second_pass_over_contents_changes_nothing(spark):
    docs = noisy(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    once = cleaning.drop_toc(docs).select("doc_id", "text")
    assert sorted(map(tuple, cleaning.drop_toc(once).collect())) == sorted(map(tuple, once.collect()))


def test_sections_and_positions():
    text = "before\n# One Title\nabc\n## Two Title\ndef\n# Three Title\nghi"
    starts, found = splitting.sections(text)
    assert [text[a:].split("\n")[0] for a in starts] == ["# One Title", "## Two Title", "# Three Title"]
    assert [p for _, _, p in found] == [["One Title"], ["One Title", "Two Title"], ["Three Title"]]
    assert splitting.positions("abc def abc def", ["abc", "def", "abc", "nowhere"], 0) == [0, 4, 8, 11]


def test_cutting_by_sections_and_types():
    body = "word and more words here. " * 8
    text = "".join(f"## Title number {'abcd'[k]}\n{body}\n" for k in range(4))
    got = splitting.by_sections(text, splitting.Sizes(least=50))
    assert [t for t, _ in got] == [f"## Title number {c}" for c in "abcd"]
    joined = splitting.by_sections(text, splitting.Sizes(least=400))
    assert [t.count(" / ") for t, _ in joined] == [1, 1]
    table = "| a | b |\n| --- | --- |\n" + "| 1 | 2 |\n" * 5
    assert splitting.content_type(table) == "table" and [k for k, _ in splitting.table_blocks(f"x\n{table}\ny")] == [False, True, False]
    cut = splitting.by_sections(f"## Long section\n{table}\n" + "sentence one. " * 300, splitting.Sizes())
    assert any(c.startswith("| a | b |") or "| 1 | 2 |" in c for _, c in cut) and "(partie 1/" in cut[-2][0] + cut[-1][0] + cut[1][0]
    assert all(len(c) <= 2000 for _, c in cut)
    contexts = [c for _, c in splitting.hybrid("## Some title\nThis is sentence number one. This is sentence number two. This is the third one.", procedural=True)]
    assert len(contexts) == 3 and len(set(contexts)) == 1
    assert splitting.by_sections("short", splitting.Sizes()) == [("Document", "short")]


def test_token_windows_keep_the_text():
    rng = random.Random(5)
    for _ in range(100):
        text = "".join(rng.choice(["word ", "a", ".", "\n", " é", "_"]) for _ in range(rng.randrange(1, 80)))
        assert "".join(splitting.plain_tokens(text)).rstrip() == text.rstrip()
        parts = list(splitting.token_windows(text, 7, 2))
        assert bool(parts) == bool(text.strip()) and all(p in text for p in parts)


def test_boundaries_by_a_provider(spark):
    body = "A sentence of this part which is long enough to be kept. "
    docs = spark.createDataFrame([(1, f"START ONE {body}START TWO {body}"), (2, body), (3, None)], "doc_id int, text string")

    def provider(texts):
        if "START" not in texts[0]:
            raise OSError
        return [[("two", "START TWO"), ("one", "START ONE"), ("none", "not there")]]

    got = only(chunking.boundary_chunks(docs, provider), "doc_id", "chunk_title")
    assert got == [(1, "one"), (1, "two"), (2, "Document")]


@pytest.mark.parametrize("value", [None, "", "short"])
def test_quality_of_odd_texts(spark, value):
    got = curation.quality_score(texts(spark, value), "text").select(F.round("quality_score", 4)).first()[0]
    assert got == (0.15 if value else 0.0)


def test_functions_for_sql(spark):
    register(spark)
    row = spark.sql("SELECT ascii_slug('Été chaud.md') AS s, count_tokens('two words.') AS n, size(embed_text('x')) AS d, ascii_slug(NULL) AS e").first()
    assert tuple(row) == ("Ete_chaud.md", 3, 64, None)
    cut = spark.sql("SELECT d.id, c.chunk_index, c.content FROM VALUES (1, 'one two three four'), (2, '') AS d(id, t), LATERAL split_text(d.t, 10, 0) AS c ORDER BY 1, 2")
    assert [tuple(r) for r in cut.collect()] == [(1, 0, "one two"), (1, 1, "three"), (1, 2, "four")]
