import math
import random

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from stockloom.llm import chat, langid, toxicity
from stockloom.llm.queries import QUERIES, raw_transcripts
from stockloom.llm.tokens import token_blocks, tokens


def test_tokens():
    text = "Dr. Émile paid 3,500.25 dollars, 12km on. Été 7"
    found = tokens(text.encode(), text.lower().encode())
    words = ["dr", "émile", "paid", "3,500.25", "dollars", "12km", "on", "été", "7"]
    alone = [tokens(w.encode(), w.encode()).hashes[0] for w in words]
    assert found.hashes.tolist() == alone
    assert np.flatnonzero(found.number).tolist() == [3, 8]
    assert np.flatnonzero(found.measure).tolist() == [5]
    assert np.flatnonzero(found.capital).tolist() == [0, 1, 7]
    assert np.flatnonzero(found.opening).tolist() == [0, 1, 7]


def test_token_blocks_do_not_depend_on_their_size():
    text = " ".join(f"Wört{i % 37}{'.' * (i % 5 == 0)} 3.{i}" for i in range(3000))
    whole = list(token_blocks(text))
    parts = list(token_blocks(text, 100))
    assert len(whole) == 1 and len(parts) > 100
    for k in range(5):
        assert np.array_equal(whole[0][k], np.concatenate([p[k] for p in parts]))
    assert list(token_blocks(None)) == list(token_blocks("")) == list(token_blocks(" .,! ")) == []


def test_gram_counts_do_not_depend_on_blocks(monkeypatch):
    text = "Überall in Frankreich, été ö. " * 50
    whole = langid.counts(text)
    assert whole[1].sum() == 3 * len(text) - 3
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, langid.counts(text)))


def test_gram_probabilities_equal_plain_bayes(spark):
    rows = [("aa b" * 4000, "x"), ("ab", "x"), ("b" * 4000, "y"), ("zz", None)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model["langs"] == ["x", "y"]
    counted = {lang: sum((np.bincount(langid.slots(t), minlength=langid.SLOTS) for t, n in rows if n == lang)) for lang in "xy"}
    for i, lang in enumerate("xy"):
        grams = counted[lang] + langid.SMOOTHING
        assert np.allclose(model["matrix"][i], np.log(grams / grams.sum()), atol=1e-5)
    assert np.allclose(np.exp(model["prior"]), [2 / 3, 1 / 3])
    name, score = langid.score("B", model["langs"], model["matrix"], model["prior"])
    assert name == "y" and 0.5 < score < 1


def test_language_of_held_out_documents(spark, documents):
    got = QUERIES["op4_language_bayes"](spark, SF_DIR).join(documents.select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert got.count() == documents.count() and len(rows) > 20
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_language_of_odd_rows(odd_docs, no_docs):
    model = langid.train(odd_docs)
    got = langid.identified(odd_docs, model)
    assert sorted(got.columns) == sorted(odd_docs.columns)
    by = {r.doc_id: r for r in got.collect()}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0) for i in (None, 3, 4, 5, 9) if i is not None)
    assert by[8].lang_pred == "de" and by[6].lang_pred == by[7].lang_pred == "en"
    kept = langid.accepted(odd_docs, model)
    assert kept.columns == odd_docs.columns and {r.score for r in kept.collect()} == {0.5}
    assert {3, 4, 5, 9}.isdisjoint({r.doc_id for r in kept.collect()})
    nothing = langid.train(no_docs)
    assert nothing["langs"] == [] and langid.identified(no_docs, nothing).collect() == []
    assert {r.lang_pred for r in langid.identified(odd_docs, nothing).collect()} == {"und"}


def plain_gains(rows):
    """Gains of words and of pairs by the definitions; ``rows``: (words, toxic)."""
    texts, before = {}, {}
    for words, toxic in rows:
        for v, w in set(zip(["", *words], words)):
            texts.setdefault((v, w), [0, 0])[toxic] += 1
    for (v, w), n in texts.items():
        before.setdefault(w, [set(), set()])
        for c in (0, 1):
            if n[c]:
                before[w][c].add(v)
    both = {w: len(a | b) for w, (a, b) in before.items()}

    def discount(counts):
        ones, twos = sum(n == 1 for n in counts), sum(n == 2 for n in counts)
        d = min(1.0, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))
        return d, sum(min(n, d) if n >= toxicity.LEAST else n for n in counts) / sum(counts)

    d1, r1 = discount(both.values())
    d2, r2 = discount([sum(n) for n in texts.values()])
    classes = sum(bool(a) + bool(b) for a, b in before.values())
    total = [sum(max(len(before[w][c]) - d1, 0) for w in both if both[w] >= toxicity.LEAST) for c in (0, 1)]

    def word(w, c):
        rest = r1 * sum(map(bool, before[w])) / classes
        if both[w] < toxicity.LEAST:
            return rest
        return (1 - r1) * max(len(before[w][c]) - d1, 0) / total[c] + rest

    gains = {w: math.log(word(w, 1) / word(w, 0)) for w in both}
    own = {k: n for k, n in texts.items() if sum(n) >= toxicity.LEAST}
    behind = {v: [sum(max(n[c] - d2, 0) for (u, _), n in own.items() if u == v) for c in (0, 1)] for v, _ in own}
    pairs = {}
    for (v, w), n in own.items():
        if all(behind[v]):
            p = [(1 - r2) * max(n[c] - d2, 0) / behind[v][c] + r2 * word(w, c) for c in (0, 1)]
            pairs[v, w] = math.log(p[1] / p[0]) - gains[w]
    return tuple({k: g for k, g in some.items() if abs(g) >= toxicity.SLIGHT} for some in (gains, pairs))


def plain_numbers(words, gains, pairs):
    single = [gains.get(w, 0.0) for w in words]
    double = [pairs.get(p, 0.0) for p in zip(["", *words], words)]
    if not words:
        return 0.0, 0.0, 0.0
    peak = max(sum(single[i : i + toxicity.WINDOW]) for i in range(max(1, len(words) - toxicity.WINDOW + 1)))
    return (sum(single) + sum(double)) / len(words), peak / toxicity.WINDOW, max(double)


def drawn_texts(phrase=None):
    drawn, rows = random.Random(3), []
    for i in range(400):
        words = [f"w{drawn.randrange(60)}" for _ in range(30)]
        if phrase:  # both words are as frequent in each class, but only toxic texts have them side by side
            a, b = phrase if i % 5 == 0 else (phrase[0], "w1")
            at = drawn.randrange(28)
            words[at : at + 2] = a, b
            if i % 5:
                words += ["w2", phrase[1]]
        elif i % 5 == 0:
            words[drawn.randrange(30)] = "rotter"
        rows.append((words, int(i % 5 == 0)))
    return rows


@pytest.mark.parametrize("phrase", [None, ("you", "pig")])
def test_toxicity_equals_plain_models_both_ways(spark, phrase, monkeypatch):
    rows = drawn_texts(phrase)
    gains = toxicity.train(spark.createDataFrame([(" ".join(w), t) for w, t in rows], "text string, toxic int"))
    plain = plain_gains(rows)
    texts = [w for w, _ in rows[:40]] + [[], ["w1"], ["rotter"], ["never", "seen"], ["you", "pig"] * 40]
    docs = spark.createDataFrame([(i, " ".join(w), "x") for i, w in enumerate(texts)], "id int, text string, peak string")
    got = {}
    for held in (toxicity.HELD, 0):
        found = toxicity.compared(docs, gains, held)
        assert found.columns == ["id", *toxicity.NUMBERS]
        got[held] = sorted(tuple(r) for r in found.collect())
        for i, *numbers in got[held]:
            assert numbers == pytest.approx(plain_numbers(texts[i], *plain), abs=0.01)
    assert got[0] == got[toxicity.HELD]
    if phrase:
        single, double = plain
        assert double["you", "pig"] > 1 > abs(single.get("you", 0)) and abs(single.get("pig", 0)) < 1
    else:
        assert min(r[2] for r in got[0][:40:5]) > max(r[2] for r in got[0][:40] if r[0] % 5)
    bits = toxicity.bit_table(gains.table.select("key"), toxicity.FILTER_BITS)
    table = gains.table.orderBy("key").toPandas()
    blocks = toxicity.token_blocks
    monkeypatch.setattr(toxicity, "token_blocks", lambda t: blocks(t, 16))
    for i, *numbers in got[0]:
        columns = (table[c].to_numpy() for c in ("key", "gain", "pair"))
        assert toxicity.compared_text(" ".join(texts[i]), bits, *columns) == tuple(numbers)


def test_toxicity_by_a_table_above_the_limit_shuffles_and_stages_nothing(spark, monkeypatch):
    rows = drawn_texts()
    made, stage = [], toxicity.stage
    monkeypatch.setattr(toxicity, "stage", lambda df, label: made.append(label) or stage(df, label))
    gains = toxicity.train(spark.createDataFrame([(" ".join(w), t) for w, t in rows], "text string, toxic int"))
    docs = spark.createDataFrame([(i, " ".join(w * (i % 4))) for i, (w, _) in enumerate(rows[:40])], "id int, text string")
    wanted = toxicity.compared(docs, gains, gains.n)
    made.clear()
    monkeypatch.setattr(toxicity, "PIECE", gains.n // 5)
    found = toxicity.compared(docs, gains, gains.n - 1)
    assert not made and "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


@pytest.mark.parametrize("most", [0, 50, 10**6])
def test_toxicity_of_long_texts_in_pieces(monkeypatch, most):
    class Piece:  # as a worker has it
        def __init__(self, columns):
            self.columns = columns

        @property
        def value(self):
            return self.columns

    texts = [None, "", *(" ".join(w) for w, _ in drawn_texts()[:20]), "w1", "rotter " * 99]
    blocks = toxicity.token_blocks
    monkeypatch.setattr(toxicity, "token_blocks", lambda t: blocks(t, 16))
    some = np.concatenate([np.concatenate((w, toxicity._pair_keys(toxicity._short(b), w))) for t in texts for b, w in toxicity._hash_blocks(t)])
    keys = np.unique(some)[::3].view(np.int64)
    keys.sort()
    columns = (keys, np.arange(len(keys)) / 1024 - 0.03, np.arange(len(keys)) % 2 == 0)
    bits = np.full(1 << 5, 0xFFFFFFFF, np.uint32)  # lets all through
    pieces = [Piece(tuple(c[i:j] for c in columns)) for i, j in ((0, 5), (5, 5), (5, 40), (40, None))]
    assert toxicity.compared_in_pieces(texts, bits, pieces, most) == [toxicity.compared_text(t, bits, *columns) for t in texts]


def test_toxicity_trains_from_packed_pairs(spark, monkeypatch):
    rows = drawn_texts(("you", "pig"))
    known = spark.createDataFrame([(" ".join(w), t) for w, t in rows], "text string, toxic int")
    made, stage = {}, toxicity.stage
    monkeypatch.setattr(toxicity, "stage", lambda df, label: made.setdefault(label, stage(df, label)))
    wanted = sorted(map(tuple, toxicity.train(known).table.collect()))
    texts = {}
    for words, _ in rows:
        for pair in set(zip(["", *words], words)):
            texts[pair] = texts.get(pair, 0) + 1
    own = sum(n >= toxicity.LEAST for n in texts.values())
    staged = made["toxicity-pairs"]  # rare pairs are only counted
    assert staged.where("before is not null").count() == own < len(texts)
    sums = staged.where("before is null").groupBy().sum("n", "ones", "twos", "texts").first()
    assert tuple(sums) == (len(texts), *(sum(n == k for n in texts.values()) for k in (1, 2)), sum(texts.values()))
    monkeypatch.setattr(toxicity, "PAIRS", 40)  # many runs of pairs, and of buckets
    made.clear()
    assert sorted(map(tuple, toxicity.train(known).table.collect())) == wanted


def test_packed_pairs_are_small_and_whole():
    drawn = np.random.default_rng(3)
    words = np.sort(drawn.choice(drawn.integers(0, 1 << 64, 500, np.uint64), 30_000))
    before = drawn.integers(-(1 << 31), 1 << 31, len(words)).astype(np.int32)
    pairs = toxicity._summed([(words, before, np.ones(len(words), int), np.zeros(len(words), int))] * 2)
    packed = toxicity._packed(*pairs)
    parts = [toxicity._unpacked(*row) for row in zip(*packed.to_pydict().values()) for row in [row[1:]]]
    assert all((a == b).all() for a, b in zip(toxicity._summed(parts), pairs))
    assert len(set(packed.column(0).to_pylist())) == packed.num_rows <= toxicity.BUCKETS
    assert sum(map(len, packed.column(3).to_pylist())) < 16 * len(words)


def test_toxicity_of_held_out_documents(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES["op3_toxicity_kneser_ney"](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    marked = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in marked) >= 0.6 * len(marked)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.05 * len(rows)


def test_toxicity_without_one_class_and_of_odd_rows(spark, odd_docs, no_docs):
    one = spark.createDataFrame([("a b", 1), (None, 1), ("", 1)], "text string, toxic int")
    gains = toxicity.train(one)
    assert gains.table.isEmpty() and gains.n == 0
    known = toxicity.compared(one, gains).withColumn("apart", F.lit(False))
    for held in (toxicity.HELD, -1):
        odd = toxicity.compared(odd_docs, gains, held)
        assert odd.count() == odd_docs.count()
        assert odd.select(toxicity.score(toxicity.fitted(known)).alias("s")).where("s < 0.999").count() == 0
        none = toxicity.fitted(known.where("toxic = 0"))
        assert odd.select(toxicity.score(none).alias("s")).where("s > 0.001").count() == 0
        assert toxicity.compared(no_docs, gains, held).collect() == []
    clashing = odd_docs.selectExpr("*", "1 as total", "2 as best", "3 as gain", "4 as key", "5 as at", "6 as __n")
    for held in (toxicity.HELD, -1):
        odd = toxicity.compared(clashing, gains, held)
        assert odd.count() == odd_docs.count() and {"total", "best", "gain", "key", "at"} < set(odd.columns)
        assert odd.where("total = 1 and best = 2 and gain = 3 and key = 4 and at = 5").count() == odd.count()
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (77, 1)], "doc_id long, toxic int")
    assert toxicity.labelled(odd_docs, labels).count() == 4


@pytest.fixture(scope="module")
def chat_model(spark):
    pieces = raw_transcripts(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    return chat.train(pieces.where(~langid.held_out("conv_id", 5, 0)))


def test_chat_roles_of_held_out_conversations(spark, chat_model):
    sf_dir = "/root/testdata/sf0.01"
    true = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", F.col("turn").alias("first_seq"), F.col("role").alias("true_role"))
    got = QUERIES["op8_chat_roles"](spark, sf_dir).where("held_out").join(true, ["conv_id", "first_seq"]).collect()
    assert len(got) > 90
    assert sum(r.role == r.true_role for r in got) / len(got) > 0.9


def test_chunks_give_the_path_of_the_whole(spark, chat_model, monkeypatch):
    drawn = random.Random(4)
    texts = []
    for i in range(90):
        role = drawn.choice(["User: ", "Assistant: ", "", "\n", "[system] ", "### AI\n"])
        texts.append(role + "\n".join(f"word {drawn.randrange(99)}" * drawn.randrange(1, 9) for _ in range(drawn.randrange(1, 4))))
    pieces = spark.createDataFrame([(c, i, t) for c in (1, 2) for i, t in enumerate(texts[: 90 if c == 1 else 5])], "conv_id long, seq long, text string")
    for conv, own in ((1, texts), (2, texts[:5])):
        lines = [line for t in own for line in t.split("\n")]
        scores = chat._scores(lines, chat_model)
        best, back = chat_model.start + scores[0], []
        for row in scores[1:]:
            steps = best[:, None] + chat_model.step
            back.append(steps.argmax(0))
            best = steps.max(0) + row
        path = [int(best.argmax())]
        for came in reversed(back):
            path.append(int(came[path[-1]]))
        wanted = [(line, chat.ROLES[s // 2], s % 2 == 0) for line, s in zip(lines, path[::-1])]
        for chunk in (2, 7, 1000):
            monkeypatch.setattr(chat, "CHUNK", chunk)
            got = chat.lines_with_roles(pieces, chat_model).where(F.col("conv_id") == conv).orderBy("chunk", "at").collect()
            assert [(r.line, r.role, r.begins) for r in got] == wanted


def test_chat_of_odd_rows(spark, chat_model):
    rows = [(1, 0, None, 5), (1, 1, "", 5), (None, 0, "User: x", 5), (2, None, "User: x", 5), (3, 7, "User: hi\nthere", 5), (3, 7, "User: hi\nthere", 5)]
    pieces = spark.createDataFrame(rows, "conv_id long, seq long, text string, chunk int")
    got = chat.turns(pieces, chat_model).collect()
    assert {r.conv_id for r in got} == {1, 3}
    third = [r for r in got if r.conv_id == 3]
    assert sum(r.role == "user" and r.rendered.startswith("<|user|>\nhi") for r in third) == 2
    assert sum(r.lines for r in third) == 4
    assert chat.turns(pieces.limit(0), chat_model).collect() == []
    assert chat.train(raw_transcripts(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).start.shape == (6,)


def test_rendering():
    assert chat.rendered("\n\nUser: hello\nyou") == "hello\nyou"
    assert chat.rendered("### Assistant\nfine") == "fine"
    assert chat.rendered("plain: text") == "plain: text"
