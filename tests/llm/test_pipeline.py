import hashlib
import os

import corpus_pipeline
import public_tokenizers
import pytest
import test_decontaminate
import test_line_dedup
import test_simhash
from helpers import SF, edge_docs, empty_docs, rows_of
from test_toxicity import naive_score

from carlot.llm import toxicity
from carlot.llm.common import table


def brute_force(rows, lexicon, items):
    """(doc_id, text) through all stages by the brute-force versions of their operators' tests."""
    rows = [(i, t or "") for i, t in rows if naive_score(lexicon, t or "") < 0.5]
    # line dedup: keys of three documents or more stay in the largest id alone
    holders: dict[str, list] = {}
    for i, t in rows:
        for k in {test_line_dedup.key_of(x) for x in t.split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(i)
    keeper = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= 3}
    kept = lambda i, t: "\n".join(x for x in t.split("\n")
                                  if (k := test_line_dedup.key_of(x)) not in keeper or (keeper[k] == i and i is not None))
    rows = [(i, kept(i, t)) for i, t in rows]
    # near-duplicates: the row of the least id of each component (NULL being greater than any)
    label = test_simhash.linked([test_simhash.fingerprint(t if len(t) < 100_000 else t[:1000]) for _, t in rows], 4)
    best: dict[int, tuple] = {}
    for n, (i, _) in enumerate(rows):
        key = (i is None, i or 0, n)
        best[label[n]] = min(best.get(label[n], key), key)
    rows = [rows[n] for n in sorted(k[2] for k in best.values())]
    leaks = {(i, t) for i, t in rows if test_decontaminate.expected([(i, t)], items)}
    rows = [r for r in rows if r not in leaks]
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        sha = hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        out.append((i, len(ids), sha, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=repr)


def as_folder(docs, labels, benchmark, path):
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        df.write.parquet(os.path.join(path, f"{name}.parquet"))
    return path


def test_whole_table_by_brute_force(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    want = brute_force(rows, toxicity.learn(docs, labels), items)
    got = rows_of(corpus_pipeline.run(spark, SF))
    assert got == want and 0.6 * len(rows) < len(got) < len(rows)


def test_edge_cases_by_brute_force(spark, tmp_path):
    """NULLs, repeated rows and ids, empty and long texts, extra columns with clashing names."""
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 0, 1), (None, 1, 0), (4, None, None)], "doc_id bigint, quality int, toxic int")
    items = [(1, "one two three four five six seven eight nine ten"), (2, None), (3, "")]
    folder = as_folder(docs, labels, spark.createDataFrame(items, "item_id bigint, text string"), str(tmp_path / "t"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    lexicon = toxicity.learn(docs, labels)
    got = rows_of(corpus_pipeline.run(spark, folder))
    want = brute_force(rows, lexicon, [(i, t or "") for i, t in items])
    assert [r[1:] for r in got] == [r[1:] for r in want] and len(got) < len(rows)


def test_stages_keep_columns(spark, tmp_path):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id bigint, quality int, toxic int")
    folder = as_folder(docs, labels, spark.createDataFrame([(1, "a b c d")], "item_id bigint, text string"), str(tmp_path / "t"))
    for given in (docs, empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, folder)
            assert out.dtypes == docs.dtypes, name
            assert out.count() <= given.count()
        assert corpus_pipeline.STAGES[-1][1](spark, given, folder).count() == given.count()


def test_empty_tables(spark, tmp_path):
    benchmark = table(spark, SF, "benchmark").limit(0)
    labels = table(spark, SF, "labels").limit(0)
    folder = as_folder(empty_docs(spark), labels, benchmark, str(tmp_path / "t"))
    assert rows_of(corpus_pipeline.run(spark, folder)) == []


def test_intermediates_are_deleted(spark):
    from carlot import session
    before = set(session._made())
    corpus_pipeline.run(spark, SF)
    left = [os.path.basename(p) for p in session._made() if p not in before]
    assert [p.rpartition("-")[0] for p in left] == ["pipeline-decontamination"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_every_stage_is_named_for_an_operator(name):
    assert name in ("toxicity", "line_dedup", "simhash", "decontamination", "bpe")
