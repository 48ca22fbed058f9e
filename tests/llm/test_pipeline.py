"""Every stage of the corpus pipeline against a plain version, on the small table."""

import math

import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

import corpus_pipeline
from churnlens.llm import kneser_ney as K
from churnlens.llm.mixing import MOST_SWEEPS, TOLERANCE
from churnlens.llm.queries import PIECES
from churnlens.llm.sentencepiece import Vocabulary
from churnlens.sources.tables import read_table

from .plain import bounded_mix, kneser_ney, near_groups

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_shape():
    assert list(STAGES) == ["quality", "exact_dedup", "near_dedup", "mix", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality(spark):
    docs = read_table(spark, SF, "documents")
    got = STAGES["quality"](spark, docs, SF)
    assert got.columns == COLUMNS
    labels = [(r.doc_id, r.quality, r.toxic) for r in read_table(spark, SF, "labels").collect()]
    trusted = {i for i, q, t in labels if q == 1 and not t}
    held = {r.id for r in K.trusted_ids(read_table(spark, SF, "labels")).where(K._held_out(K.F.col("id"))).collect()}
    every = rows(docs)
    models = {}
    for lang in {r.lang for r in every.values()}:
        models[lang] = kneser_ney([r.text for r in every.values() if r.lang == lang and r.doc_id in trusted - held], K.ORDER)
    surprise = {i: models[r.lang](r.text) for i, r in every.items()}
    figures, means = {}, {}
    for lang in models:
        own = [i for i in held if every[i].lang == lang]
        if own:
            means[lang] = sum(sum(surprise[i]) for i in own) / sum(len(surprise[i]) for i in own)
    for i, s in surprise.items():
        mean = means.get(every[i].lang)
        wide = sorted(sum(s[k : k + K.WINDOW]) for k in range(0, len(s) - K.WINDOW + 1, K.WINDOW))
        figures[i] = {
            "score": None if mean is None else (sum(s) + K.PRIOR_UNITS * mean) / (len(s) + K.PRIOR_UNITS),
            "uneven": (wide[int(len(wide) * 0.75)] - wide[int(len(wide) * 0.25)]) / K.WINDOW if len(wide) >= 4 else None,
        }

    def rank(values, q):  # the smallest value that at least a share q doesn't exceed
        values = sorted(values)
        return values[max(0, math.ceil(q * len(values)) - 1)]

    fences = {}
    for name, least in K.LEAST_SPREAD.items():
        by = {lang: [figures[i][name] for i in held if every[i].lang == lang and figures[i][name] is not None] for lang in means}
        mid = {lang: rank(v, 0.5) for lang, v in by.items() if v}
        pooled = rank([x - mid[lang] for lang, v in by.items() for x in v], 0.9)
        for lang, v in by.items():
            if v:
                fences[lang, name] = mid[lang] + K.FENCE * max(rank(v, 0.9) - mid[lang], pooled, least)
    want = set()
    for i, r in every.items():
        over = [figures[i][n] is not None and (r.lang, n) in fences and figures[i][n] > fences[r.lang, n] for n in K.LEAST_SPREAD]
        if not any(over):
            want.add(i)
    assert set(rows(got)) == want
    assert len(want) > 0.8 * len(every)


def test_dedups_and_mix(spark):
    docs = read_table(spark, SF, "documents")
    last = {}
    for r in docs.collect():
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    exact = STAGES["exact_dedup"](spark, docs, SF)
    assert exact.columns == COLUMNS and set(rows(exact)) == set(last.values())

    groups = near_groups([(r.doc_id, r.text) for r in docs.collect()])
    near = STAGES["near_dedup"](spark, docs, SF)
    assert near.columns == COLUMNS and set(rows(near)) == {i for i, (_, c) in groups.items() if c == i}

    drawn, _ = bounded_mix([(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()], tolerance=TOLERANCE, sweeps=MOST_SWEEPS, **corpus_pipeline.MIX)
    mixed = STAGES["mix"](spark, docs, SF)
    assert mixed.columns == COLUMNS and mixed.count() == len(rows(mixed)) and set(rows(mixed)) == {i for i, n in drawn.items() if n}


def test_run(spark):
    """The whole run: the stages one after another, and tokens that spell the texts."""
    docs = read_table(spark, SF, "documents")
    kept = docs
    for name in ("quality", "exact_dedup", "near_dedup", "mix"):
        kept = STAGES[name](spark, kept, SF).checkpoint()
    got = rows(corpus_pipeline.run(spark, SF))
    texts = rows(kept)
    assert set(got) == set(texts) and got
    model = pb.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    lib = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    vocab = Vocabulary.load(PIECES)
    for i, r in got.items():
        assert r.round_trip and lib.decode(r.token_ids) == texts[i].text
        assert r.n_tokens == len(r.token_ids) and max(r.token_ids) < len(vocab.pieces)


def test_empty(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        assert out.columns == COLUMNS or name == "tokens"
