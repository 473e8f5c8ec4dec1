"""The pipeline's stages on small tables, each against brute force on its own input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from termloom.llm import bpe

from .test_model_operators import toxic_rows
from .test_text_operators import brute_components

COLUMNS = corpus_pipeline.COLUMNS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents: labelled toxic and clean ones, boilerplate, copies, odd rows."""
    path, rng = str(tmp_path_factory.mktemp("tables")), random.Random(9)
    base = toxic_rows(240)
    docs = [(i, text + ("\nall rights reserved" if i % 2 else ""), "en", f"s{i % 3}") for i, text, _ in base]
    clean = [d for d in docs if not base[d[0]][2] and len(d[1].split()) > 30]
    docs += [(1000 + i, rng.choice(clean)[1] + " plus", "en", "s0") for i in range(30)]
    docs += [(2000, None, None, None), (2001, "", "en", "s1"), (None, "no id here at all", "en", "s2"), (5, docs[5][1], "en", "s2")]
    rows = [(*d, None if d[1] is None else len(d[1])) for d in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in base], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """Input and output rows of every stage, each written and read again."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        found[name] = docs.collect(), after.collect(), after.columns
        docs = after
    return found


def test_stages_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near duplicates", "mixing", "token ids"]
    assert all(columns == COLUMNS for name, (_, _, columns) in stages.items() if name != "token ids")


def test_toxic_documents_go_and_others_stay(stages):
    before, after, _ = stages["toxicity"]
    toxic = {i for i, _, y in toxic_rows(240) if y}
    kept = {r["doc_id"] for r in after}
    gone = {r["doc_id"] for r in before} - kept
    assert len(gone & toxic) >= 0.9 * len(toxic) and len(gone - toxic) <= 2
    assert {None, 2000, 2001} <= kept


def test_lines(stages):
    before, after, _ = stages["line dedup"]
    pages, having = Counter(r["source"] or "" for r in before), Counter()
    for r in before:
        having.update((r["source"] or "", line.strip(" ")) for line in {x.strip(" ") for x in (r["text"] or "").split("\n")} - {""})
    bad = {k for k, n in having.items() if n >= 5 and n > 0.01 * pages[k[0]]}
    assert bad

    def cleaned(r):
        if r["text"] is None:
            return None
        return "\n".join(line for line in r["text"].split("\n") if (r["source"] or "", line.strip(" ")) not in bad)

    assert Counter((r["doc_id"], r["source"], cleaned(r)) for r in before) == Counter((r["doc_id"], r["source"], r["text"]) for r in after)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in after)


def test_one_of_each_group_stays(stages):
    before, after, _ = stages["near duplicates"]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in before]
    expected = {d for d, _, c in brute_components(rows) if d is not None and d == c}
    assert Counter(r["doc_id"] for r in after if r["doc_id"] is not None) == Counter(expected)
    assert sum(r["doc_id"] is None for r in after) == sum(r["doc_id"] is None for r in before)


def test_mix_meets_its_targets(stages):
    before, after, _ = stages["mixing"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken, by_doc = defaultdict(int), defaultdict(int), Counter()
    for r in before:
        sizes[r["source"]] += size(r["text"])
    for r in after:
        taken[r["source"]] += size(r["text"])
        by_doc[r["doc_id"]] += size(r["text"])
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), abs=3)
    assert all(taken[s] <= 2 * n for s, n in sizes.items())
    own = defaultdict(int)
    for r in before:
        own[r["doc_id"]] += size(r["text"])
    assert all(n <= 2 * own[d] for d, n in by_doc.items())
    texts = {r["doc_id"]: r["text"] for r in before}
    assert all(r["text"] in texts[r["doc_id"]] for r in after)


def test_ids_of_the_mix(stages):
    before, after, _ = stages["token ids"]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))

    def digests(r):
        ids = library.encode_ordinary(r["text"])
        return (r["doc_id"], len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest())

    assert Counter(map(digests, before)) == Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after)


def test_pipeline_over_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
