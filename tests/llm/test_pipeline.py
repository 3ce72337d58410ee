"""The corpus pipeline, stage by stage, against brute force."""

import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from stratiq.llm import toxicity
from tests.llm.test_operators import near_copies, plain_groups, plain_spans

SF = "/root/testdata/sf0.1"


def plain_toxic(text, model):
    """The score by plainly compressing every window, without the operator's code."""
    params = zstandard.ZstdCompressionParameters(window_log=17, chain_log=14, hash_log=14, search_log=5, min_match=3, target_length=32, strategy=zstandard.STRATEGY_LAZY2, write_content_size=0, write_checksum=0, write_dict_id=0)
    packers = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(c + toxicity.HEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params) for c in (model.ordinary, model.toxic)]
    pieces, held = [], b""
    for word in (text or "").encode().lower().split():
        if held and len(held) + 1 + len(word) > 20:
            pieces.append(held)
            held = b""
        if len(word) > 20:
            pieces += [word[i : i + 20] for i in range(0, len(word) - 10, 10)]
        else:
            held = held + b" " + word if held else word
    pieces += [held] if held else []
    shares = np.zeros(21)
    for p in pieces:
        ordinary, toxic = (len(c.compress(toxicity.HEAD + b" " + p + toxicity.TAIL)) for c in packers)
        shares[min(10, max(-10, ordinary - toxic)) + 10] += 1 / len(pieces)
    return 1 / (1 + np.exp(-(np.sqrt(shares) @ np.array(model.weights) + model.offset)))


def plain_contaminated(text, items):
    """Any window as long as an item at weighted shingle similarity 0.8, by plain counting."""
    cut = str.maketrans(dict.fromkeys("!\"'(),.:;?[]", " "))
    split = lambda t: "".join(c.lower() if c.isascii() else c for c in t.translate(cut)).encode().split()
    shingles = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    words = split(text or "")
    own = {tuple(words[i : i + 5]) for i in range(len(words))}
    for item in items:
        w = split(item or "")
        s = shingles(w)
        if w and words and len(own & set(s)) >= 0.8 * len(set(s)) - 1e-9:
            span = min(len(w), len(words))
            for i in range(len(words) - span + 1):
                x = shingles(words[i : i + span])
                both = sum((x & s).values())
                if both >= 0.8 * (sum(x.values()) + sum(s.values()) - both):
                    return True
    return False


def planted_toxic():
    rng = np.random.default_rng(9)
    syllables = ["ban", "to", "ri", "mek", "sul", "ona", "pe", "gar"]
    out = []
    for i in range(300):
        words = ["".join(rng.choice(syllables, 3)) for _ in range(50)]
        if bad := i % 3 == 0:
            for at in rng.choice(50, 4, replace=False):
                words[at] = "vilezug" + rng.choice(syllables)
        out.append((i, " ".join(words), bad))
    return out


@pytest.fixture(scope="module")
def documents(spark):
    """Some hundred documents, near copies, benchmark passages and awkward rows, with clashing columns."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400").select(*columns)
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").head()["text"]
    rows = [(5000, None), (5001, ""), (5002, " \n"), (5003, passage), (5004, "before " + passage + " after"), (None, "loose text"), (None, passage), (5005, "token=abcdefghijk only"), (5006, "a text that stands twice, in full"), (5006, "a text that stands twice, in full"), (5006, "another text of that id")]
    rows += [(6000 + i, t) for i, t in near_copies(30)]
    rows += [(7000 + i, t) for i, t, _ in planted_toxic()]
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], docs.schema)
    every = docs.unionByName(odd).withColumn("score", F.lit(7.5)).withColumn("rep", F.lit("r")).withColumn("spans", F.lit("s")).withColumn("similarity", F.lit(1)).withColumn("cluster", F.lit(2))
    return spark.createDataFrame(every.collect(), every.schema).repartition(6)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables whose labels cover the planted documents too."""
    root = str(tmp_path_factory.mktemp("tables"))
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    planted = spark.createDataFrame([(7000 + i, int(bad)) for i, _, bad in planted_toxic()], labels.schema)
    labels.where("doc_id < 400").unionByName(planted).write.parquet(f"{root}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, documents, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "secrets", "packing"]
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, folder)
        if name != "packing":
            assert made.columns == docs.columns and made.where("score <> 7.5 or rep <> 'r'").count() == 0
        rows = made.collect()
        seen[name] = (docs.collect(), rows)
        docs = spark.createDataFrame(rows, made.schema).repartition(5)
    pairs = lambda rows: Counter((r["doc_id"], r["text"]) for r in rows)

    before, after = map(pairs, seen["toxicity"])
    model = toxicity.fit(documents, spark.read.parquet(f"{folder}/labels.parquet"))
    assert after == Counter({k: n for k, n in before.items() if plain_toxic(k[1], model) < 0.3})
    gone = {i for i, _ in before - after}
    assert len(gone & {7000 + i for i, _, bad in planted_toxic() if bad}) > 90 and len(gone & {7000 + i for i, _, bad in planted_toxic() if not bad}) < 10

    before, after = map(pairs, seen["near_copies"])
    keys = {k: zlib.crc32(repr(k).encode()) for k in before if k[0] is not None}
    assert len(set(keys.values())) == len(keys)
    groups = plain_groups([(keys[k], k[1]) for k in keys], 5, 80, 100)
    least = {}
    for k, i in keys.items():
        least.setdefault(groups[i][1], []).append(k)
    kept = Counter(k for k in after.elements() if k[0] is not None)
    assert set(kept.values()) == {1} and len(kept) == len(least)
    for members in least.values():
        ids = [k[0] for k in members if k in kept]
        assert ids == [min(k[0] for k in members)]
    assert Counter({k: n for k, n in after.items() if k[0] is None}) == Counter({k: n for k, n in before.items() if k[0] is None})

    before, after = map(pairs, seen["decontamination"])
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert after == Counter({k: n for k, n in before.items() if not plain_contaminated(k[1], items)}) and before != after

    before, after = map(pairs, seen["secrets"])
    assert Counter(i for i, _ in before.elements()) == Counter(i for i, _ in after.elements())
    assert Counter(k for k in before.elements() if not plain_spans(k[1] or "")) - after == Counter()
    assert not any(plain_spans(t or "") for _, t in after) and (5005, "[SECRET] only") in after
    assert all(r["n_chars"] == len(r["text"]) for r in seen["secrets"][1] if r["n_chars"] is not None and r["text"] is not None)

    sizes, packed = Counter(), Counter()
    for i, t in after.elements():
        sizes[i] += len((t or "").encode()) + 1
    for r in seen["packing"][1]:
        packed[r["doc_id"]] += r["size"]
    assert packed == sizes


def test_stages_of_nothing(spark, documents):
    docs = documents.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
