"""The corpus pipeline stage by stage against brute force, each on its own input."""

import random

from test_llm_dedup import family, naive_components, naive_repeats, one_edit
from test_llm_tokens import check_pack
from tokenizers import Tokenizer

import corpus_pipeline
from lendstar.llm import packing
from lendstar.llm.common import stored


def documents():
    rnd = random.Random(12)
    docs = family(rnd, 120, 12, 4, 0) + family(rnd, 60, 8, 1, 50)
    passage = " ".join(f"passage{rnd.randrange(10**5)}" for _ in range(60))
    for k in range(100, 130):
        lines = [" ".join(f"clean{rnd.randrange(10**6)}" for _ in range(rnd.randrange(4, 30))) for _ in range(4)]
        if k % 3 == 0:
            lines[1] = f"{lines[1]} {passage} {lines[2]}"
        if k % 4 == 0:
            lines.append(f"this is a common footer line {k % 8}")
        docs.append((k, "\n".join(lines)))
    return docs + [(200, None), (201, "123 --- 456"), (202, ""), (203, docs[0][1])]


def lines_left(docs):
    places = [(i, p, x.strip(" ").lower()) for i, t in docs for p, x in enumerate(t.split("\n")) if len(x.strip(" ")) >= 10]
    gone = {(i, p) for i, p, x in places if any((j, q) < (i, p) and one_edit(x, y) for j, q, y in places)}
    return {i: "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in docs}


def test_stages(spark):
    docs = documents()
    df = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in docs],
                               "doc_id long, text string, lang string, source string, n_chars long")
    texts = dict(docs)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "line dedup", "MinHash near-dedup", "suffix-array dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, df, ""), "test-stage")
        if name == "packing":
            tok = Tokenizer.from_file(packing.public_tokenizers.path(packing.VOCABULARY))
            check_pack([r.asDict() for r in out.collect()], texts, tok, packing.WINDOW)
            break
        assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
        got = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "language ID":
            want = {i: t for i, t in texts.items() if i not in (200, 201, 202)}
        elif name == "line dedup":
            want = {i: t for i, t in lines_left(texts.items()).items() if t.strip()}
            assert len(want) < len(texts)
        elif name == "MinHash near-dedup":
            want = {i: texts[i] for i, (_, c) in naive_components(list(texts.items()), 5, 80).items() if i == c}
            assert len(want) < len(texts)
        else:
            want = {i: r[3].decode() for i, r in naive_repeats(list(texts.items()), 200).items()}
            assert want != texts
        assert got == want
        assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        df, texts = out, got


def test_run_and_empty(spark, tmp_path, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_entry_registers_one_query_of_each(spark):
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
