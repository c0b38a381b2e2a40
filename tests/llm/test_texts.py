import datetime
import random
import re

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from stockloom.llm import decontaminate, line_dedup, pii
from stockloom.llm.bits import among, bit_table, holds
from stockloom.llm.queries import QUERIES

ITEMS = [
    (1, "Alice has 5 apples and gives Bob 3 apples while Alice keeps the rest of her 5 apples in 12 kg boxes."),
    (2, "A train leaves the station at 9 and travels 120 km before it meets the other slow train."),
    (3, "Too short"),
    (4, None),
    (5, ""),
    (None, "An item without any id is left out of it all, since nobody could name it."),
]
TEXTS = [
    (10, "Intro. Alice has 5 apples and gives Bob 3 apples while Alice keeps the rest of her 5 apples in 12 kg boxes. End."),
    (11, "Intro. Carol has 7 apples and gives Dan 2 apples while Carol keeps the rest of her 7 apples in 30 lb boxes. End."),
    (12, "Intro. Carol has 7 apples and gives Dan 2 apples while Erin keeps the rest of her 8 apples in 30 lb boxes. End."),
    (13, "and so TOO SHORT it is"),
    (14, "A train leaves the station at 9 and then something else happens to all of the people there."),
    (15, None),
    (16, ""),
    (17, "An item without any id is left out of it all, since nobody could name it."),
    (None, "a train leaves the station at 10 and travels 80 km before it meets the other slow train"),
]


def test_bits(spark):
    drawn = random.Random(0)
    values = [drawn.getrandbits(64) - (1 << 63) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "h long")
    import numpy as np

    table = bit_table(df, 12)
    assert holds(table, np.array(values, np.int64)).all()
    others = [drawn.getrandbits(64) - (1 << 63) for _ in range(2000)]
    plain = holds(table, np.array(others, np.int64))
    assert 0.02 < plain.mean() < 0.3
    other = spark.createDataFrame([(v,) for v in others], "h long").withColumn("may", among(F.col("h"), df, 12))
    assert [r.may for r in other.collect()] == plain.tolist()
    assert df.where(among(F.col("h"), df, 12)).count() == 500
    assert df.where(among(F.col("h"), df.limit(0), 12)).count() == 0


def test_templates(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, items).collect()}
    assert set(got) == {(10, 1), (11, 1), (13, 3), (None, 2)}
    assert got[10, 1].changed == 0 < got[11, 1].changed
    left = decontaminate.clean(docs.withColumn("hash", F.lit(1)), items)
    assert left.columns == ["doc_id", "text", "hash"]
    assert {r.doc_id for r in left.collect()} == {12, 14, 15, 16, 17}
    for a, b in ((docs.limit(0), items), (docs, items.limit(0))):
        assert decontaminate.contaminated(a, b).collect() == []
    assert decontaminate.clean(docs, items.limit(0)).count() == len(TEXTS)


def test_reparameterised_questions_are_found(spark):
    items = [
        (1, "Tom has five red marbles. Ann takes three of them. Tom then counts what is left in the bag."),
        (2, "the quick brown fox jumps over the lazy dog while the farmer looks on from the old barn door"),
        (3, "Mix 5 kg and 3 kg, 12 ml and 9 ml, 40 g and 7 g, then heat 20 minutes at 180 degrees."),
        (4, "A shop sells pencils in boxes of twelve and every class of the school buys four boxes each autumn term."),
    ]
    texts = [
        (10, "Sue has five red marbles. Max takes three of them. Sue then counts what is left in the bag."),
        (11, "Sue has five red marbles. Max takes three of them. Kim then counts what is left in the bag."),
        (20, "The Quick Brown Fox Jumps Over The Lazy Dog While The Farmer Looks On From The Old Barn Door"),
        (30, "Mix 8 kg and 1 kg, 15 ml and 6 ml, 60 g and 2 g, then heat 35 minutes at 200 degrees."),
        (40, "A shop sells pencils in boxes of twelve and every single class of the school buys four boxes each autumn term."),
        (50, "Then he counts what is left of the red marbles while the farmer looks on and every class heats water."),
        (51, "In 2019 Anna Schmidt sold 40 kg of apples, 30 kg of pears and 20 kg of plums to 12 shops in Bremen."),
        (52, "Kim Has 3 Cats. Lee Has 4 Dogs. Sam Has 5 Cows. Pat Has 6 Pigs. Jo Has 7 Hens. Al Has 8 Ducks."),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(10, 1), (20, 2), (30, 3), (40, 4)}


def test_templates_do_not_depend_on_blocks(monkeypatch):
    text = "Alice has 5 km. " * 300 + "then Bob said 3.5 words of some length again and again to all. " * 20
    units = decontaminate._unit_hashes()

    def found():
        out = {}
        cut = decontaminate._windows(text, [3, 8], units, np.zeros(1 << 17, np.uint32))
        for n, (size, first, hashes, use, raw, slot) in enumerate(cut):
            for i, h in enumerate(hashes.tolist()):
                assert (n % 2, size, first + i) not in out
                out[n % 2, size, first + i] = h, bool(use[i]), tuple(slot[i : i + size].tolist())
        return out

    whole = found()
    blocks = decontaminate.token_blocks
    monkeypatch.setattr(decontaminate, "token_blocks", lambda t: blocks(t, 24))
    assert found() == whole


def test_copied_items_of_driver_tables(spark, documents):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    bare = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    texts = {d.doc_id: bare(d.text) for d in docs}
    wanted = {(i, b.item_id) for i, t in texts.items() for b in items if bare(b.text) in t}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op1_benchmark_templates"](spark, sf_dir).collect()}
    assert got == wanted and wanted


def test_lines_equal_plain_version(spark):
    drawn = random.Random(9)
    words = [f"{drawn.choice('bcdfgklm')}{drawn.choice('aeiou')}{drawn.choice('lnrst')}{i}" for i in range(80)]
    base = [" ".join(drawn.choices(words, k=40)) for _ in range(6)]
    lines = ["", "  ", "short", "short", "tiny"]
    for b in base:
        for _ in range(30):
            parts = b.split(" ")
            for _ in range(drawn.randrange(0, 3)):
                parts[drawn.randrange(40)] = drawn.choice(words)
            lines.append(" ".join(parts))
    lines += [" ".join(drawn.choices(words, k=40)) for _ in range(20)] + ["é" * 9, "é" * 12, "x" * 40_000, "x" * 40_001]
    drawn.shuffle(lines)
    docs = [(i, "\n".join(lines[i * 8 : i * 8 + 8])) for i in range(len(lines) // 8 + 1)]
    df = spark.createDataFrame([*docs, (900, None), (901, "")], "doc_id long, text string")
    filled = list(dict.fromkeys(t for _, text in docs for t in text.split("\n") if t.strip()))
    roots = brute.line_components(filled)
    seen, wanted = set(), {900: (0, 0, []), 901: (1, 1, [])}
    for i, text in docs:
        gone = []
        for pos, t in enumerate(text.split("\n")):
            if t.strip():
                if roots[t] in seen:
                    gone.append(pos)
                seen.add(roots[t])
        n = len(text.split("\n"))
        wanted[i] = (n, n - len(gone), gone)
    for bucket in (line_dedup.BUCKET, 10):
        line_dedup.BUCKET, old = bucket, line_dedup.BUCKET
        try:
            got = {r.doc_id: (r.lines, r.kept_lines, r.dropped) for r in line_dedup.documents(df).collect()}
        finally:
            line_dedup.BUCKET = old
        assert got == wanted
    texts = {r.doc_id: r.text for r in line_dedup.without_copies(df.withColumn("pos", F.lit(1))).collect()}
    for i, text in docs:
        parts = text.split("\n")
        assert texts[i] == "\n".join(t for k, t in enumerate(parts) if k not in wanted[i][2])


def test_lines_of_equal_runs_and_unlike_lengths_are_one(spark):
    docs = [(1, "-" * 20), (2, "-" * 200), (3, "=" * 10 + "\n" + "=" * 300), (4, "a line of its own, said once")]
    got = {r.doc_id: r.dropped for r in line_dedup.documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [0], 3: [1], 4: []}


@pytest.mark.parametrize("bucket", [64, 4])
def test_planted_pairs_are_met(spark, monkeypatch, bucket):
    """Pairs at 0.8 to 0.95, alone and among lines that share half their runs with them, hence in large buckets."""
    monkeypatch.setattr(line_dedup, "BUCKET", bucket)
    monkeypatch.setattr(line_dedup, "HUBS", 4)
    drawn = random.Random(3)
    text = lambda n: "".join(drawn.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    lines, shared = [], text(130)
    for i in range(150):
        line = text(240) if i % 2 else shared + text(110)
        cut = drawn.choice([3, 8, 14, 20])  # of 240 characters, at the end
        lines += [line, line[:-cut] + text(cut)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r.doc_id: r.kept_lines for r in line_dedup.documents(docs).collect()}
    runs = [{t[k : k + 8] for k in range(len(t) - 7)} for t in lines]
    close = [i for i in range(0, len(lines), 2) if len(runs[i] & runs[i + 1]) >= 0.8 * len(runs[i] | runs[i + 1])]
    assert len(close) > 100
    assert sum(found[i + 1] == 0 for i in close) >= 0.99 * len(close)
    assert sum(n == 0 for n in found.values()) <= len(close)


def test_pairs_of_one_large_bucket_only_are_met(spark, monkeypatch):
    """Pairs that agree in a single band, in a bucket whose hubs are like none of them, are compared all the same."""
    monkeypatch.setattr(line_dedup, "BUCKET", 4)
    monkeypatch.setattr(line_dedup, "HUBS", 4)
    drawn = random.Random(5)
    text = lambda n: "".join(drawn.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    lines = [text(120) for _ in range(20)]
    lines += [line[:-k] + text(k) for k, line in zip((3, 5, 8), lines[8:])] + ["-" * 20, "-" * 900]
    rows = [(7, i, 0, len(lines)) for i in range(len(lines))]
    buckets = spark.createDataFrame(rows, "key long, id long, sketch long, n long")
    texts = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    places = spark.createDataFrame([(i, 100 - i) for i in range(len(lines))], "id long, count long")
    wanted = [(8, 20), (9, 21), (10, 22), (23, 24)]
    for block in (512, 3):
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        found = line_dedup.similar_pairs(buckets, texts, places, 0.8).where("a <> b")
        assert sorted(tuple(sorted(r)) for r in found.collect()) == wanted


def test_shared_shingles_are_counted_in_parts(monkeypatch):
    lines = ["the quick brown fox jumps", "the quick brown dog jumps over", "----------", "short"]
    sets = [{t[k : k + 8] for k in range(max(1, len(t) - 7))} for t in lines]
    runs = [line_dedup._runs(t) for t in lines]
    for columns in (1 << 12, 3):
        monkeypatch.setattr(line_dedup, "COLUMNS", columns)
        assert line_dedup._shared(runs, runs[:3]).tolist() == [[len(a & b) for b in sets[:3]] for a in sets]


def test_lines_are_hashed_together(monkeypatch):
    """A check of many pairs hashes short lines together, and finds what a check of one pair by one finds."""
    drawn = random.Random(4)
    text = lambda n: "".join(drawn.choices("abc \u00e9", k=n))
    lines = ["a", "-" * 20, "-" * 900, *(text(n) for n in range(1, 200))]
    lines += [line[:-2] + text(2) for line in lines]
    sets = [{t[k : k + 8] for k in range(max(1, len(t) - 7))} for t in lines]
    pairs = [(i, j) for i in range(len(lines)) for j in (1, 2, i, (i + 202) % 404)]
    wanted = [(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    rows = {"a": [i for i, _ in pairs], "b": [j for _, j in pairs]}
    rows |= {"line_a": [lines[i] for i in rows["a"]], "line_b": [lines[j] for j in rows["b"]]}
    batch, hashes, calls = pa.RecordBatch.from_pydict(rows), line_dedup._hashes, []
    monkeypatch.setattr(line_dedup, "_hashes", lambda units: calls.append(len(units)) or hashes(units))
    for piece, held in ((1 << 16, 1 << 21), (300, 1 << 21), (300, 50)):
        monkeypatch.setattr(line_dedup, "PIECE", piece)
        monkeypatch.setattr(line_dedup, "HELD", held)
        calls.clear()
        found = [tuple(r.values()) for out in line_dedup._verify([batch, batch.slice(0, 0)], 0.8) for r in out.to_pylist()]
        assert found == wanted
        assert piece == 300 or len(calls) == 1


def test_signatures_are_least_hashes_of_any_pieces(monkeypatch):
    lines = ["a", "x" * 500, "quick brown foxes", "\u00e9" * 9, "0123456789" * 30, "12345678"]
    factors = line_dedup._factors()
    wanted = [[min(int(h >> np.uint64(32)) * int(f) % 2**32 for h in line_dedup._runs(t)) for t in lines] for f in factors]
    for piece in (1 << 16, 100, 9, 8):
        monkeypatch.setattr(line_dedup, "PIECE", piece)
        assert line_dedup._least(lines, factors).tolist() == wanted


def test_blank_lines_are_told_without_a_pattern(spark):
    lines = ["", " ", "\t\x0b\f\r ", "\u00a0", "\u2003", " a", "\x00", "\x1c", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    found = line_dedup._lines(docs)
    assert {r.doc_id: r.id is None for r in found.collect()} == {
        i: not re.search(r"[^ \t\n\x0b\f\r]", t) for i, t in enumerate(lines) if t is not None
    }
    assert "RLIKE" not in found._jdf.queryExecution().toString()


def test_lines_of_odd_rows(odd_docs, no_docs):
    got = line_dedup.documents(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert sum(r.kept_lines for r in got) < sum(r.lines for r in got)
    assert line_dedup.documents(no_docs).collect() == []
    left = line_dedup.without_copies(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()


def _feistel(spark, pairs, low, high):
    df = spark.createDataFrame(pairs, "l long, r long")
    moved = pii.feistel(F.col("l"), F.col("r"), F.lit(low), F.lit(high), F.lit("test"), "key")
    return [(r.m.left, r.m.right) for r in df.select(moved.alias("m")).collect()]


def test_feistel_permutes_its_domain(spark):
    for low, high in ((1, 7), (5, 9), (17, 30)):
        domain = [(a, b) for a in range(low) for b in range(high)]
        assert sorted(_feistel(spark, domain, low, high)) == domain


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += sum(divmod(2 * int(d), 10)) if i % 2 else int(d)
    return total % 10 == 0


def test_pseudonyms_keep_form_validity_and_links(spark):
    texts = [
        "card 4111 1111 1111 1111, again 4111-1111-1111-1111 and 378282246310005; not 4111111111111112",
        "call +1 (274) 555-9629 or 274-555-9629 or 415.555.2671.",
        "ssn 123-45-6789, none 000-12-3456 666-12-3456",
        "ip 17.57.238.115. none 300.1.1.1 1.2.3.4.5",
        "born 1984-02-29, 29/02/1984; none 2023-02-30 31/31/2000",
        "mail Eis.74@mail8.example.com. eis.74@MAIL8.example.com",
        "abc4111111111111111 x1.2.3.4 nothing",
        None,
        "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("pii", F.lit("old"))
    rows = {r.doc_id: r for r in pii.pseudonymised(df, "key").collect()}
    new = {i: r.text for i, r in rows.items()}
    kinds = {i: [p.kind for p in r.pii] for i, r in rows.items()}
    assert kinds[0] == ["card"] * 3 and kinds[1] == ["phone"] * 3 and kinds[2] == ["ssn"]
    assert kinds[3] == ["ip"] and kinds[4] == ["isodate", "date"] and kinds[5] == ["email"] * 2
    assert kinds[6] == kinds[7] == kinds[8] == [] and (new[6], new[7], new[8]) == (texts[6], None, "")
    form = lambda t: re.sub(r"\d", "9", t)
    assert all(form(new[i]) == form(texts[i]) and new[i] != texts[i] for i in (0, 1, 2, 4))
    cards = [re.sub(r"\D", "", p.pseudonym) for p in rows[0].pii]
    assert cards[0] == cards[1] and all(map(luhn, cards)) and cards[0][0] == "4" and cards[2][0] == "3"
    phones = [re.sub(r"\D", "", p.pseudonym)[-10:] for p in rows[1].pii]
    assert phones[0] == phones[1] != phones[2]
    iso, plain = (p.pseudonym for p in rows[4].pii)
    assert datetime.date.fromisoformat(iso) == datetime.datetime.strptime(plain, "%d/%m/%Y").date()
    assert "4111111111111112" in new[0] and "000-12-3456 666-12-3456" in new[2] and "300.1.1.1 1.2.3.4.5" in new[3]
    assert len({p.pseudonym for p in rows[5].pii}) == 1 and "mail8" not in new[5].lower()
    assert pii.pseudonymised(df, "other").where("doc_id = 2").first().text != new[2]
    assert pii.pseudonymised(df.limit(0), "key").collect() == []


def test_pseudonyms_are_one_to_one(spark):
    drawn = random.Random(6)
    ssns = {f"{drawn.choice([1, 665, 667, 899]):03}-{drawn.randrange(1, 100):02}-{drawn.randrange(1, 10000):04}" for _ in range(300)}
    ips = {".".join(str(drawn.randrange(256)) for _ in range(4)) for _ in range(300)}
    values = sorted(ssns | ips)
    df = spark.createDataFrame([(v,) for v in values], "text string")
    got = [r.text for r in pii.pseudonymised(df, "key").collect()]
    assert len(set(got)) == len(values)
    again = pii.pseudonymised(spark.createDataFrame([(v,) for v in got], "text string"), "key")
    assert again.where("size(pii) = 1").count() == len(values)


def test_long_texts_take_linear_time(spark):
    text = "a" * 200_000 + " " + "1." * 100_000 + " " + "7 " * 100_000
    df = spark.createDataFrame([(text,)], "text string")
    assert pii.pseudonymised(df, "key").first().text == text


def test_no_private_value_of_driver_tables_stays(spark, documents):
    mail = r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) \d{3}-\d{4}"
    old = {m for r in documents.collect() for m in re.findall(mail, r.text)}
    new = "\n".join(r.text for r in QUERIES["op7_feistel_pseudonyms"](spark, SF_DIR).collect())
    assert old and not [m for m in old if m in new]


def test_usual_forms_of_private_values_are_found(spark):
    texts = {
        "card 4111 1111 1111 1111 12/27": ["card"],
        "card 4111 1111 1111 1111 123.": ["card"],
        "5 4111 1111 1111 1111": ["card"],
        "2024 12 05 4111-1111-1111-1111": ["card"],
        "4111 1111 1111 1111 2024-02-29 and 12 12 123-45-6789": ["card", "isodate", "ssn"],
        "3782 822463 10005 1234 99": ["card"],
        "born 12/27/1984": ["date"],
        "call +14155552671 or 1-800-555-1234 or 1-8005551234 or +1 4155552671": ["phone"] * 4,
    }
    none = ["born 13/32/1984", "4111 1111 1111 1112 123", "1 2 3 4 5 6 7 8 9 10 11 12 14 15 16", "no 14155552671"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *none])], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.pseudonymised(df, "key").collect()}
    for i, (text, kinds) in enumerate(texts.items()):
        assert [p.kind for p in rows[i].pii] == kinds
        new, form = rows[i].text, lambda t: re.sub(r"\d", "9", t)
        assert form(new) == form(text) and not re.search("4111.1111.1111.1111|822463|6789|12/27/1984|5552671|5551234", new)
        assert all(luhn(re.sub(r"\D", "", p.pseudonym)) for p in rows[i].pii if p.kind == "card")
    assert [rows[len(texts) + i].text for i in range(len(none))] == none
    assert rows[1].text.endswith(" 123.") and rows[2].text.startswith("5 4")


def test_dates_with_the_month_first_are_one_to_one(spark):
    day = datetime.date(1900, 1, 1)
    dates = [day + datetime.timedelta(37 * i) for i in range(1900)]
    late = [f"{d:%m/%d/%Y}" for d in dates if d.day > 12]
    values = [*late, *(f"{d:%d/%m/%Y}" for d in dates)]
    df = spark.createDataFrame([(v,) for v in values], "text string")
    got = [r.text for r in pii.pseudonymised(df, "key").collect()]
    assert len(set(got)) == len(values)
    assert all(datetime.datetime.strptime(t, "%m/%d/%Y").day > 12 for t in got[: len(late)])


def test_values_of_an_item_may_become_equal(spark):
    item = "near the old river a farmer has {} apples and then gives {} apples to the boy who sells {} more of them"
    long = " and then ".join(["the farmer who came here sold {} of them"] * 11)
    items = spark.createDataFrame([(1, item.format(5, 3, 9)), (2, long.format(5, *range(11, 20), 5))], "item_id long, text string")
    texts = [
        item.format(4, 4, 7),
        long.format(7, *range(21, 30), 8),  # one odd slot of eleven
        long.format(5, *range(11, 20), 5).replace("and then", "then"),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.slots, r.changed) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(0, 1): (3, 3), (1, 2): (11, 11)}
