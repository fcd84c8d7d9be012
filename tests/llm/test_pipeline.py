import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from llm.conftest import SF
from llm.test_decontaminate import plain as leaks
from llm.test_packing import check as check_packing
from llm.test_simhash_dedup import plain as simhash

from shelfwise.llm import queries, secret_scan
from shelfwise.llm.common import stage, table

ROOT = Path(__file__).resolve().parents[2]


def test_stages_one_by_one_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    rows = docs.collect()
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, SF), f"test-{name}")
        got = out.collect()
        if name != "packing":
            assert out.columns == columns
        if name == "language_id":
            assert set(got) <= set(rows) and len(got) >= 0.97 * len(rows)
        elif name == "simhash_dedup":
            comp = {i: c for i, _, c in simhash([(r["doc_id"], r["text"]) for r in rows])}
            assert sorted(r["doc_id"] for r in got) == sorted(i for i, c in comp.items() if i == c)
        elif name == "decontaminate":
            items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
            bad = {d for d, _ in leaks([(r["doc_id"], r["text"]) for r in rows], items)}
            assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in rows if r["doc_id"] not in bad)
        elif name == "secret_scan":
            want = {r["doc_id"]: secret_scan.redact(r["text"], secret_scan.spans(r["text"], queries.WORD_LIST)) for r in rows}
            assert {r["doc_id"]: r["text"] for r in got} == want
            assert all(r["n_chars"] == len(r["text"]) for r in got)
        else:
            check_packing(got, [(r["doc_id"], r["text"]) for r in rows])
        docs, rows = out, got


def test_edges_pass_every_stage(spark, docs_of):
    odd = docs_of([(1, "the same plain english words here again and again", "en"), (1, "the same plain english words here again and again", "en"), (2, None, None),
                   (3, "", "en"), (None, "plain english words without any id at all", None), (4, "password=abcdefgh12345 " + "word " * 40_000, "en")])
    for empty in (False, True):
        docs = odd.where("doc_id < 0") if empty else odd
        for name, step in corpus_pipeline.STAGES:
            before = docs.columns
            docs = stage(step(spark, docs, SF), f"odd-{name}")
            assert name == "packing" or docs.columns == before
        assert docs.count() == 0 if empty else docs.count() > 0


@pytest.mark.parametrize("name", ["op1_url_reputation", "op2_simhash_dedup", "op4_chat_windows", "op5_nn_descent", "op7_html_content", "op8_secret_scan", "op10_decontaminate"])
def test_queries_give_a_row_for_each_input(spark, name):
    got = queries.QUERIES[name](spark, SF)
    source = {"op1": "pages", "op2": "documents", "op4": "conversations", "op5": "embeddings", "op7": "pages", "op8": "documents"}.get(name.split("_")[0])
    if source == "conversations":
        assert got.count() == table(spark, SF, source).select("conv_id").distinct().count() + 1
    elif source:
        assert got.count() == table(spark, SF, source).count()
    else:
        assert got.count() >= 0


def test_entry_without_this_subpackage(tmp_path):
    """The rest imports without the subpackage, but not with a broken one."""
    for d in ("shelfwise",):
        for f in (ROOT / d).rglob("*.py"):
            if "llm" not in f.parts:
                to = tmp_path / f.relative_to(ROOT)
                to.parent.mkdir(parents=True, exist_ok=True)
                to.write_text(f.read_text())
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    run = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries())[:1], 'pipeline' in e.queries())"],
                                 cwd=tmp_path, capture_output=True, text=True)
    r = run()
    assert r.returncode == 0 and "False" in r.stdout, r.stderr
    (tmp_path / "corpus_pipeline.py").write_text("import not_there_at_all\n")
    assert run().returncode != 0
