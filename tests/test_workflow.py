"""From files to answers: the pipeline, its store, providers, the command line and the stream, on small folders."""

import json
import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from quillmill import __main__ as cli
from quillmill.functions import batches
from quillmill.operators import chunking, embedding, enrichment, extraction, retrieval, review
from quillmill.pipeline import Pipeline, advanced_chunks
from quillmill.settings import Chunking, NamespaceStrategy, Settings
from quillmill.sources import files, state
from quillmill.streaming import ingest

_RNG = random.Random(3)
_SENTENCE = "La pompe {} doit être contrôlée {} par une personne {} avant la saison {}."
_BODY = lambda: " ".join(_SENTENCE.format(*("".join(_RNG.choice("aeilmnorstuv") for _ in range(7)) for _ in range(4))) for _ in range(8))
MANUAL = "".join(f"## {t}\n\n{_BODY()}\n\n" for t in ("Dépannage des pompes", "Réglage du débit", "Entretien annuel", "Sécurité"))


def folder_of(path, **texts):
    for name, text in texts.items():
        (path / f"{name}.md").write_text(text)
    return str(path)


def options(store):
    return ["--store", str(store), "--settings", f"{store}/settings"]


@pytest.fixture(scope="module")
def ingested(spark, tmp_path_factory):
    source, store = tmp_path_factory.mktemp("source"), tmp_path_factory.mktemp("store")
    # The rule for corrupted lines takes ordinary prose as well.
    (store / "settings").write_text("# comment\nDROP_CORRUPTED_LINES=false\n")
    said = cli.main([*options(store), "ingest", folder_of(source, manual=MANUAL, other=MANUAL.replace("pompe", "vanne"))], spark)
    return source, store, said


def test_ingest_ask_and_clear(spark, ingested):
    _, store, said = ingested
    assert said.startswith("(default): ") and said.endswith(" stored, 0 rejected")
    at = options(store)
    answer = cli.main([*at, "ask", "Réglage du débit des vannes", "-k", "3"], spark)
    assert answer.count("[") >= 3 and "other.md" in answer
    assert "vectors" in cli.main([*at, "stats"], spark)
    paths = cli.main([*at, "review", "--size", "5"], spark).split("\n")
    items = json.loads(open(paths[0].removeprefix("file:")).read())
    assert len(items) == 5 and items[0]["review"] == {"rating": None, "note": "", "action": None} and "<section>" in open(paths[1]).read()
    assert cli.main([*at, "clear", "chunks"], spark) == "cleared chunks"
    with pytest.raises(SystemExit):
        cli.main([*at, "review"], spark)


def test_ingesting_again_changes_nothing(spark, ingested):
    source, store, _ = ingested
    table = retrieval.VectorTable(spark, f"{store}/vectors")
    before = sorted(map(tuple, table.read().select("vec_id", "text").collect()))
    cached = embedding.EmbeddingCache(spark, f"{store}/cache").read().count()
    cli.main([*options(store), "ingest", str(source)], spark)
    assert sorted(map(tuple, table.read().select("vec_id", "text").collect())) == before
    assert embedding.EmbeddingCache(spark, f"{store}/cache").read().count() == cached


def test_evaluation_of_a_question_set(spark, ingested, tmp_path):
    _, store, _ = ingested
    asked = [{"id": "a", "question": "Réglage du débit", "expected_sources": ["manual.md"], "expected_keywords": "DÉBIT"}, {"id": "b", "question": "Entretien", "expected_labels": ["none of these"]}, {"id": "c", "question": "Sécurité"}]
    (tmp_path / "q.json").write_text(json.dumps({"questions": asked}))
    facts, *paths = cli.main([*options(store), "evaluate", str(tmp_path / "q.json")], spark).split("\n")
    facts = json.loads(facts)
    assert (facts["n_all"], facts["n_scored"], facts["hits"]) == (3, 2, 1)
    report = json.loads(open(paths[0].removeprefix("file:")).read())
    assert [q["hit"] for q in report["questions"]] == [True, False, None]


def test_advanced_chunks_know_their_section(spark):
    docs = spark.createDataFrame([(1, MANUAL, "m.md", "m.md"), (2, "tiny", "t.md", "t.md"), (3, None, "n.md", "n.md")], "doc_id long, text string, source string, file_name string")
    rows = advanced_chunks(docs, Settings(drop_corrupted_lines=False)).orderBy("chunk_index").collect()
    assert {r.doc_id for r in rows} == {1} and [r.section_title for r in rows] == ["Dépannage des pompes", "Réglage du débit", "Entretien annuel", "Sécurité"]
    assert all(r.display_content.startswith("---\nDocument: m\nSection: ") and r.rag_label for r in rows)


def test_providers_are_asked_for_good_chunks_only(spark):
    chunks = spark.createDataFrame([(i, f"text {i}", i / 10, "general", 0.45, ["x"]) for i in range(10)], "i int, content string, chunk_quality_score double, rag_label string, rag_label_confidence double, domain_tags array<string>")

    def provider(texts):
        if any(t == "text 7" for t in texts):
            raise OSError("down")
        return [f'```json\n{{"summary": "of {t}", "rag_label": "Securite", "domain_tags": ["x", "y"],}}\n```' for t in texts]

    got = {r.i: r for r in enrichment.enrich_by_provider(chunks, provider, 0.5, batch=3).collect()}
    assert len(got) == 10 and got[6].summary == "of text 6" and got[6].rag_label == "securite" and got[6].domain_tags == ["x", "y"]
    assert got[7].summary is None and got[7].rag_label == "general" and got[3].summary is None and got[3].domain_tags == ["x"]


def test_texts_go_to_the_embedder_once(spark, tmp_path):
    cache = embedding.EmbeddingCache(spark, str(tmp_path / "cache"))
    calls = spark.sparkContext.accumulator(0)

    def provider(texts):
        calls.add(len(texts))
        return embedding.hash_embed(texts)

    texts = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "embedding_text string")
    for _ in range(2):
        got = embedding.create_embeddings(texts, cache, "m", provider).collect()
        assert sorted(r.embedding is None for r in got) == [False, False, False, True] and calls.value == 2
    assert cache.stats().first().n_entries == 2
    spark.createDataFrame([("h", "m", [1.0], 7)], embedding.EmbeddingCache.SCHEMA).withColumn("prefix", F.lit("h")).write.mode("append").partitionBy("prefix").parquet(cache.path)
    assert cache.read().count() == 2  # an entry whose dimension is wrong doesn't count
    cache.clear()
    assert cache.read().count() == 0 and cache.stats().first().megabytes == 0.0


def test_retries():
    waited = []

    def fails(x):
        if len(waited) < 2:
            raise OSError
        return x

    assert embedding.with_retry(fails, sleep=waited.append)(5) == 5 and waited == [2.0, 4.0]
    with pytest.raises(ZeroDivisionError):
        embedding.with_retry(lambda: 1 / 0, sleep=waited.append)()


def test_batches_hold_what_fits():
    rng = random.Random(1)
    for _ in range(200):
        counts = [rng.choice((1, 5, 40, 99, 100, 101, 500)) for _ in range(rng.randrange(30))]
        batches: dict[int, list[int]] = {}
        for n, b in zip(counts, embedding.batch_numbers(counts, 100)):
            batches.setdefault(b, []).append(n)
        assert list(batches) == list(range(len(batches)))
        assert all(sum(x) <= 100 or len(x) == 1 for x in batches.values())
        ordered = list(batches.values())
        assert all(sum(a) + b[0] > 100 for a, b in zip(ordered, ordered[1:]))


def test_vector_table(spark, tmp_path):
    table = retrieval.VectorTable(spark, str(tmp_path / "v"), 2)
    rows = lambda *r: spark.createDataFrame(list(r), "namespace string, vec_id string, seq int, embedding array<float>, text string")
    counts = table.upsert(rows(("a", "1", 0, [1.0, 0.0], "old"), ("a", "1", 1, [0.0, 1.0], "new"), ("b/ c", "1", 0, [1.0, 1.0], "b"), ("b/ c", "2", 0, [1.0], "bad"), ("b/ c", "3", 0, None, "none")))
    assert sorted(map(tuple, counts.collect())) == [("a", 2, 0), ("b/ c", 1, 2)]
    assert sorted((r.namespace, r.vec_id, r.text) for r in table.read().collect()) == [("a", "1", "new"), ("b/ c", "1", "b")]
    table.upsert(rows(("a", "1", 1, [1.0, 0.0], "newer"), ("a", "2", 0, [1.0, 0.0], "more")))
    assert sorted((r.vec_id, r.text) for r in table.read("a").collect()) == [("1", "newer"), ("2", "more")] and table.read("b/ c").count() == 1
    with pytest.raises(ValueError):
        table.upsert(rows(("a", "9", 0, [1.0], "bad")))
    table.upsert(rows(("a", "5", 0, [1.0, 0.0], "alone")), reset=True)
    assert [r.vec_id for r in table.read("a").collect()] == ["5"] and table.namespaces() == ["a", "b/ c"]
    table.delete("b/ c")
    assert table.namespaces() == ["a"] and not (tmp_path / "v.staged").exists()
    table.delete()
    assert not table.exists()


def test_state(spark, tmp_path):
    kept = state.State(spark, str(tmp_path))
    chunks = spark.createDataFrame([(1, "x", [1.0, 2.0]), (1, "y", None), (2, "z", [1.0, 2.0])], "doc_id int, content string, embedding array<float>")
    assert kept.load_chunks() is None and not kept.has_embeddings() and kept.metadata() == {}
    kept.save_chunks(chunks)
    for n in ("", "ns"):
        kept.save_embeddings(chunks, n)
    assert kept.metadata("chunks") == {"num_files": 2, "total_chunks": 3} and kept.metadata("embeddings_ns")["embedding_dimension"] == 2
    assert kept.namespaces() == ["", "ns"] and kept.load_embeddings("ns").count() == 3 and "(default)" in kept.status()
    kept.clear_embeddings("ns")
    assert kept.namespaces() == [""] and kept.has_chunks()
    kept.clear_all()
    assert not kept.has_chunks() and kept.namespaces() == [] and kept.metadata() == {}


def test_cleaned_files_bear_a_mark(spark, tmp_path):
    docs = spark.createDataFrame([(1, "Page 1/2\n# Titre\ncorps")], "doc_id int, text string")
    got = state.save_cleaned(docs, str(tmp_path / "clean"), "light").first()
    assert got.text == "<!-- quillmill:cleaned=light,ocr=false -->\n# Titre\ncorps" and got.clean_profile == "light"


def test_pages_by_providers(spark, tmp_path):
    for name, data in (("a.pdf", b"text"), ("b.pdf", b"scan"), ("c.pdf", b"broken"), ("d.pdf", b"none")):
        (tmp_path / name).write_bytes(data)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.pdf").write_bytes(b"text")
    found = files.read_binary_documents(spark, str(tmp_path))

    def statistics(content, most):
        if content == b"broken":
            raise ValueError("not a PDF")
        return {b"text": (9, [(100, False)] * most), b"scan": (3, [(100, True), (100, True), (90, False)]), b"none": (0, [])}[content]

    got = {r.path.rsplit("/", 1)[1]: r for r in extraction.inventory(found, statistics).collect()}
    assert {k: r.page_type for k, r in got.items()} == {"a.pdf": "text", "b.pdf": "scan", "c.pdf": None, "d.pdf": None, "e.pdf": "text"}
    assert got["b.pdf"].image_page_ratio == 0.67 and "not a PDF" in got["c.pdf"].error and got["d.pdf"].error == "no page" and got["a.pdf"].num_pages == 9
    inventory = extraction.inventory(found, statistics)
    assert (extraction.of_kind(inventory, "scan").count(), extraction.of_kind(inventory).count()) == (1, 3)

    def broken(content):
        raise OSError("offline")

    def post(payload, timeout):
        assert timeout == 180.0 and payload["messages"][0]["content"][1]["document_url"].startswith("data:application/pdf;base64,")
        return {"choices": [{"message": {"content": "# Remote text\nwith a sentence that is long enough to stay here."}}]}

    texts = extraction.scanned_text(found, broken, extraction.remote_ocr(post))
    good, bad = extraction.failures(texts)
    assert good.count() == 5 and bad.count() == 0 and "# Remote text" in good.first().text
    assert extraction.failures(extraction.basic_text(found, broken))[1].count() == 5
    pages = extraction.basic_text(found, lambda content: ["First page has a sentence that stays.", "Second page has one as well, it seems."])
    assert pages.first().text == "First page has a sentence that stays.\n\nSecond page has one as well, it seems."
    spans = lambda content: [(0, 0, 0, 0, 20.0, " Big "), (0, 1, 0, 0, 10.0, "the body of the page which is long"), (0, 1, 1, 0, 10.0, "and goes on in a second line.")]
    assert extraction.structured_text(found, spans).first().text == "# Big\n\nthe body of the page which is long and goes on in a second line."
    assert "Kept line" in extraction.markdown_text(found, lambda content: "# Kept line\ntext").first().text


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    folder_of(source, one=MANUAL)
    cache, table = embedding.EmbeddingCache(spark, str(tmp_path / "cache")), retrieval.VectorTable(spark, str(tmp_path / "v"), 64)
    pipeline = Pipeline(spark, Settings(chunking=Chunking.STANDARD, namespace_strategy=NamespaceStrategy.BY_FILE))
    for names in ({"one"}, {"one", "two"}):
        folder_of(source, **{n: MANUAL for n in names - {"one"}})
        ingest.ingest(ingest.stream_markdown(spark, str(source)), pipeline, cache, table, str(tmp_path / "checkpoint"), once=True).awaitTermination()
        assert set(table.namespaces()) == names
    assert files.read_markdown(spark, str(tmp_path / "missing")).count() == 0


def test_settings():
    got = Settings.of({"CHUNK_SIZE": "500", "merge_small": "false", "CHUNKING": "standard", "OTHER": "x"}, top_k=3)
    assert (got.chunk_size, got.merge_small, got.chunking, got.top_k) == (500, False, Chunking.STANDARD, 3)
    for bad in ({"chunk_size": "5"}, {"chunk_overlap": "1000", "chunk_size": "900"}, {"merge_small": "perhaps"}, {"embedding_batch_size": "101"}):
        with pytest.raises(ValueError):
            Settings.of(bad)


def test_namespaces_by_provider(spark):
    chunks = spark.createDataFrame([(i, "x" * i) for i in range(6)], "i int, content string").coalesce(1)
    config = retrieval.namespace_config('{"Pièces détachées": {"description": "parts"}, "Autre": {"id": "rest"}}')
    assert config["pièces détachées"] == "pieces_detachees" and retrieval.namespace_config("[]") == retrieval.namespace_config()

    def provider(texts):
        return ["autre"] * 3 if texts[0] == "" else ["autre"]

    got = {r.i: r.namespace for r in retrieval.classify(chunks, provider, config, batch=3).collect()}
    assert got == {0: "rest", 1: "rest", 2: "rest", 3: "pieces_detachees", 4: "pieces_detachees", 5: "pieces_detachees"}


def test_batches_are_cut_a_slice_at_a_time(spark):
    """One batch of 60 MB: as its chunks come up, the process that cuts it must not grow by as much."""

    def provider(texts):
        with open("/proc/self/statm") as f:
            resident = int(f.read().split()[1]) * 4096 // 1_000_000
        return [[(str(resident), texts[0][:10])]]

    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" ")), 4000).alias("text"))
    cut = chunking.boundary_chunks(docs, provider)
    least, most, n, chars = cut.agg(F.min(F.split("chunk_title", " ")[0].cast("int")), F.max(F.split("chunk_title", " ")[0].cast("int")), F.count("*"), F.sum(F.length("content"))).first()
    assert n == 6000 and chars == docs.agg(F.sum(F.length(F.trim("text")))).first()[0]
    assert most - least < 100, (least, most)


def test_slices_cover_a_batch():
    texts = pa.array(["a" * 10] * 2500 + [None] * 3 + ["b" * 3_000_000, "", "é" * 600_000, "c" * 600_000])
    cut = list(batches.spans(texts))
    assert [a for a, _ in cut] == [0, *(a + n for a, n in cut[:-1])] and sum(n for _, n in cut) == len(texts)
    assert all(n <= batches.MOST_ROWS and (n == 1 or pc.sum(pc.binary_length(texts.slice(a, n))).as_py() <= batches.MOST_BYTES) for a, n in cut)
    assert batches.mapped(texts, lambda t: len(t or ""), pa.int32()).to_pylist() == [len(t or "") for t in texts.to_pylist()]
    assert batches.mapped(texts.slice(5, 3), lambda t: [t], pa.list_(pa.string())).to_pylist() == [["a" * 10]] * 3
    assert len(batches.mapped(texts[:0], len, pa.int32())) == 0
    assert batches.mapped(pa.nulls(2), lambda t: t, pa.string()).to_pylist() == [None, None]


def test_positions_of_samples_are_exact(spark):
    """In many unequal tasks, of which a sort samples only some keys; with repeated and null keys as well."""
    n = 400_000
    rows = spark.range(0, n, 1, 16).select((F.col("id") * 7919 % n).alias("at")).where("at % 3 > 0 OR at < 90000")
    chunks = rows.select(F.expr("at div 8").alias("doc_id"), F.expr("at % 8").alias("chunk_index"), F.concat(F.lit("c"), F.expr("at div 8")).alias("section_hierarchy_string"), F.col("at").cast("string").alias("content"))
    every = sorted(a for a in range(n) if a % 3 or a < 90000)
    got = {r.position: int(r.content) for r in review.stratified_sample(chunks, 20).collect()}
    m = len(every)
    fixed = [0, m // 4, m // 2, 3 * m // 4, m - 1]
    assert got == {p: every[p] for p in fixed + [8 * k for k in range(1, 16)]}
    few = spark.createDataFrame([(1, 1, f"a{i}") for i in range(3)] + [(None, 1, "z"), (1, None, "y")], "doc_id int, chunk_index int, content string")
    assert sorted((r.position, r.content) for r in review.stratified_sample(few).collect()) == [(0, "a0"), (1, "a1"), (2, "a2"), (3, "y"), (4, "z")]
    plain = spark.range(50).select(F.lit(1).alias("doc_id"), F.col("id").alias("chunk_index"), F.lit("").alias("content"))
    assert sorted(r.position for r in review.stratified_sample(plain, 8, seed=None).collect()) == [0, 1, 2, 3, 12, 25, 37, 49]
    assert review.stratified_sample(plain.where("false")).count() == 0


def test_small_samples_are_whole(spark):
    chunks = spark.createDataFrame([(1, i, f"c{i}") for i in range(4)], "doc_id int, chunk_index int, content string")
    assert [r.id for r in review.review_items(review.stratified_sample(chunks)).orderBy("id").collect()] == [0, 1, 2, 3]
    nested = chunks.groupBy("doc_id").agg(F.collect_list(F.struct("*")).alias("chunks"))
    assert review.flatten(nested).count() == 4 and review.flatten(chunks) is chunks
