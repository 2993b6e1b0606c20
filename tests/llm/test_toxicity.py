import random

from pyspark.sql import functions as F

from tests.llm.cases import docs, odd_rows, prose
from tidemark.llm import toxicity as T


def labelled(spark, rng, n=1500):
    rows, marks = odd_rows(2000), []
    for i in range(1000, 1000 + n):
        bad = i % 4 == 0
        words = prose(rng, 40).split()
        if bad:
            words.insert(rng.randrange(40), rng.choice(["scumbag", "idiot", "IDIOT", "scummy", "gränt" + str(i)[-1:]]))
        elif i % 5 == 0:
            words.insert(rng.randrange(40), "harmless scumble")
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    labels = spark.createDataFrame(marks + [(None, 1), (5, None), (99999, 1)], "doc_id long, toxic int")
    return rows, dict(marks), docs(spark, rows), labels


def test_held_out_accuracy_disguise_and_exceptions(spark):
    rng = random.Random(9)
    rows, marks, d, labels = labelled(spark, rng)
    lexicon = T.learn(d, labels)
    scored = T.score(d, lexicon).select("doc_id", "score", "predicted", (T.fold_of("doc_id") == 0).alias("held"))
    out = {r.doc_id: r for r in scored.collect()}
    assert scored.count() == len(rows) and all(0 <= r.score <= 1 for r in out.values())
    held = [i for i in marks if out[i].held]
    assert len(held) > 80 and sum(out[i].predicted == marks[i] for i in held) / len(held) > 0.97
    low = out[2].score
    assert out[1].score == low == out[3].score and out[None].predicted == 0
    tries = [(1, "you 1d1ot there"), (2, "уou idiоt there"), (3, "id​iot"), (4, "harmless scumble"),
             (5, "x" * 10**6), (6, "idiot " + "word " * 3)]
    got = {r.doc_id: r.predicted for r in T.score(docs(spark, tries), lexicon).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 1}


def test_held_out_labels_are_not_used(spark):
    rng = random.Random(10)
    _, _, d, labels = labelled(spark, rng, 800)
    flipped = labels.withColumn("toxic", F.when(T.fold_of("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.learn(d, labels), T.learn(d, flipped)
    assert a == b


def test_matching_equals_brute_force():
    rng = random.Random(11)
    lexicon = T.Lexicon({"ab": 2.0, "abc ": 3.0, "b ": 1.0, "cab": 1.5}, ["ab c", "b a"])
    matcher = lexicon.matcher()
    for _ in range(2000):
        text = "".join(rng.choice("abc ,") for _ in range(rng.randrange(0, 25)))
        want = {}
        for m in T._WORD.finditer(text):
            ws = [w for t, w in lexicon.weights.items() if m[0] == t.strip() or (not t.endswith(" ") and m[0].startswith(t))]
            if ws:
                want[m.start()] = max(ws)
        for p in lexicon.exceptions:
            at = text.find(p)
            while at >= 0:
                end = at + len(p)
                if (not at or not text[at - 1].isalnum()) and (end == len(text) or not text[end].isalnum()):
                    want = {k: v for k, v in want.items() if not at <= k < end}
                at = text.find(p, at + 1)
        assert T.hits(matcher, text) == want, text


def test_without_labels_or_rows(spark):
    d = docs(spark, odd_rows(50))
    lexicon = T.learn(d, spark.createDataFrame([], "doc_id long, toxic int"))
    scores = {r.score for r in T.score(d, lexicon).collect()}
    assert len(scores) == 1 and T.score(docs(spark, []), lexicon).collect() == []


def test_lexicons_of_one_session_do_not_meet(spark):
    text = docs(spark, [(1, "one idiot here")])
    for _ in range(6):
        got = []
        for word in ("idiot ", "moron "):  # of equal size, freed and made again
            lexicon = T.Lexicon({T.fold(word): 5.0})
            got.append(T.score(text, lexicon).first().score)
            del lexicon
        assert got[0] > got[1] and got[1] == T.score(text, T.Lexicon({"x ": 5.0})).first().score


def test_entries_inside_scripts_without_blanks(spark):
    matcher = T.Lexicon({"笨蛋": 3.0, "ばか": 2.0, "bad ": 1.0}).matcher()
    assert T.hits(matcher, T.fold("你是笨蛋吗")) == {2: 3.0}
    assert T.hits(matcher, "おまえばかです bad笨蛋 badly") == {3: 2.0, 8: 1.0, 11: 3.0}
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(600):
        text = "".join(rng.choice("天地玄黄宇宙洪荒日月盈昃辰宿列张") for _ in range(30))
        rows.append((i, text[:15] + "笨蛋" + text[15:] if i % 3 == 0 else text))
        marks.append((i, int(i % 3 == 0)))
    lexicon = T.learn(docs(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert "笨蛋" in lexicon.weights
    got = {r.doc_id: r.predicted for r in T.score(docs(spark, rows), lexicon).collect()}
    assert got == dict(marks)
