"""The pipeline's stages, each on what the stage before kept, against plain versions of them."""

import re

import corpus_pipeline as pipeline
import pytest

from docflow.llm.simhash import shingle_hashes

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LETTERS = {"en": "the of and with house garden river", "de": "der und mit haus garten fluss über", "fr": "le et avec maison jardin été", "es": "el y con casa jardín río"}


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns for a small table."""
    rows = []
    for i in range(120):
        lang = list(LETTERS)[i % 4]
        w = LETTERS[lang].split()
        rows.append((i, " ".join(f"{w[(i * 7 + k * k) % len(w)]} {w[k % len(w)]}{'abcdefgh'[(i + k) % 8]}{'ijklmnop'[(i * k) % 8]}{'qrstuvwx'[(i // 8 + k) % 8]}" for k in range(90)), lang, "s", 0))
    base = rows[5][1]
    rows += [(200, base, "de", "s", 0), (201, base + " ende", "de", "s", 0), (202, "12 34 !!", "en", "s", 0), (203, None, "en", "s", 0), (204, rows[8][1] + " password=hunter22hunter", None, "s", 0), (205, "", "en", "s", 0)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    out = {"": docs}
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, None).cache()
        out[name] = docs
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_of_documents(kept):
    assert all(df.columns == COLUMNS for name, df in kept.items() if name and name != pipeline.STAGES[-1][0])


def test_only_documents_without_a_language_go(kept):
    before, after = texts(kept[""]), texts(kept["language ID"])
    assert set(before) - set(after) == {202, 203, 205} and all(before[i] == t for i, t in after.items())
    assert {r["doc_id"]: r["lang"] for r in kept["language ID"].collect()}[204] == "en"


def test_one_of_each_group_stays(kept):
    before, after = texts(kept["language ID"]), texts(kept["SimHash near-dedup"])
    sets = {i: set(shingle_hashes(t, 5).tolist()) for i, t in before.items()}
    label = {i: i for i in sets}
    for _ in range(4):
        for a in sets:
            for b in sets:
                if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert set(after) == {i for i in label if label[i] == i} and {200, 201}.isdisjoint(after)


def test_secrets_are_gone_and_clean_documents_unchanged(kept):
    before, after = texts(kept["SimHash near-dedup"]), texts(kept["secret scans"])
    assert set(before) == set(after)
    for i, t in before.items():
        assert after[i] == re.sub(r"password=\S+", "[assign]", t)
    assert all(r["n_chars"] == len(r["text"]) for r in kept["secret scans"].collect())


def test_packing_takes_every_document(kept):
    packed = kept["best-fit packing"].collect()
    assert {r["doc_id"] for r in packed} == set(texts(kept["secret scans"]))
    filled = {}
    for r in packed:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    assert max(filled.values()) <= 1024
