import math
import random

from caseloom.llm.language import build_model, identify, language_of, suffix_automaton, train
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, score double, found string"


def symbols(text):
    out = []
    for c in text.lower():
        c = c if c.isalpha() else " "
        if not (c == " " and out and out[-1] == " "):
            out.append(c)
    return "".join(out)


def phrases(text, training):
    """Greedy longest matches by searching the training text."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in training:
            end += 1
        at = max(at + 1, end - 1)
        count += 1
    return count


def test_automaton_accepts_substrings_only():
    draw = random.Random(2)
    text = [draw.randrange(3) for _ in range(60)]
    following = suffix_automaton(text)

    def accepted(word):
        state = 0
        for symbol in word:
            if symbol not in following[state]:
                return False
            state = following[state][symbol]
        return True

    subs = {tuple(text[i:j]) for i in range(60) for j in range(i, 61)}
    for _ in range(3000):
        word = tuple(draw.randrange(3) for _ in range(draw.randrange(1, 9)))
        assert accepted(word) == (word in subs)


def test_costs_equal_search_in_the_training_text():
    training = {"a": ["the cat sat on the mat, then sang"], "b": ["der hund und die katze"]}
    model = build_model(training, train_chars=10_000)
    look_up = model.symbols_of()
    texts = ["The mat!", "katze und hund", "xyzzy", "a", "cat  --  dog é", "then " * 900]
    langs, scores, bits = identify(model, look_up, texts)
    for text, lang, score, low in zip(texts, langs, scores, bits):
        parsed, costs = symbols(text), {}
        for name, parts in training.items():
            known = symbols(parts[0])
            stretches = [parsed[i:i + 2048] for i in range(0, len(parsed), 2048)]
            count = sum(phrases(s, known) for s in stretches)
            costs[name] = count * math.log2(len(known)) / len(parsed)
        assert math.isclose(min(costs.values()), low)
        assert lang == min(costs, key=lambda n: (costs[n], n))
        assert 0.5 <= score <= 1


def test_every_letter_of_many_scripts_is_a_symbol():
    # 350 low letters beside two languages of the same lengths over letters with high code points.
    draw = random.Random(4)
    low = "".join(c for c in map(chr, range(0x61, 0x600)) if c.isalpha() and c == c.lower())[:350]
    words = [["".join(chr(draw.randrange(0x4e00, 0x5200)) for _ in range(3)) for _ in range(60)]
             for _ in range(2)]
    say = lambda k, n: " ".join(draw.choices(words[k], k=n))  # no letters that training lacks
    training = {"low": [low], **{lang: [" ".join(words[k]) + " " + say(k, 300)] for k, lang in enumerate("xy")}}
    model = build_model(training, train_chars=100_000)
    texts, truth = [], []
    for _ in range(30):
        k = draw.randrange(2)
        texts.append(say(k, draw.randrange(3, 30)))
        truth.append("xy"[k])
    langs, _, bits = identify(model, model.symbols_of(), texts)
    assert langs == truth
    for text, lang, low_bits in zip(texts, langs, bits):
        known, parsed = symbols(training[lang][0]), symbols(text)
        assert math.isclose(phrases(parsed, known) * math.log2(len(known)) / len(parsed), low_bits)


def test_kept_moves_alone_give_the_same_as_all_cells():
    draw = random.Random(6)
    training = {k: ["".join(draw.choices(a, k=900))] for k, a in (("a", "abcd "), ("b", "bcdeé. "))}
    texts = ["".join(draw.choices("abcdeéж .", k=draw.randrange(5000))) for _ in range(30)] + ["", None]
    every, kept = build_model(training), build_model(training, dense=0)
    assert every.keys is None and kept.keys is not None
    assert str(identify(every, every.symbols_of(), texts)) == str(
        identify(kept, kept.symbols_of(), texts))


def test_batches_do_not_matter():
    draw = random.Random(3)
    model = build_model({"a": ["abcabcaabbcc " * 9], "b": ["bacca cabba " * 9]})
    texts = ["".join(draw.choices("abc .", k=draw.randrange(0, 5000))) for _ in range(40)]
    look_up = model.symbols_of()
    whole = identify(model, look_up, texts)
    assert list(zip(*whole))[7] == tuple(x[0] for x in identify(model, look_up, [texts[7]]))


def test_rows_without_letters_and_extra_columns(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "der hund und die katze", "de"),
            (3, None, "en"), (4, "", None), (5, "123 !!", "fr"), (6, "the hat", None),
            (6, "the hat", None), (None, "und die hunde", None), (8, "the mat " * 40_000, None)]
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA)
    model = train(df)
    assert model.languages == ["de", "en"]
    out = df.withColumn("lid", language_of(spark, model, F.col("text"))).collect()
    assert [r.lid.lang for r in out] == ["en", "de", "und", "und", "und", "en", "en", "de", "en"]
    assert out[2].lid.score == 0.0 and all(0 <= r.lid.score <= 1 for r in out)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([], SCHEMA)
    model = train(df)
    assert df.withColumn("lid", language_of(spark, model, F.col("text"))).count() == 0
    some = spark.createDataFrame([(1, "words", None, 0.1, "x")], SCHEMA)
    assert some.select(language_of(spark, train(some), F.col("text")).alias("l")).first().l.lang == "und"


def test_held_out_accuracy(spark):
    from caseloom.llm.queries import op1_language
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = op1_language(spark, sf).filter("held_out").join(truth, "doc_id")
    right = found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97


def test_costs_of_random_texts_with_unknown_letters_equal_search():
    draw = random.Random(8)
    training = {"a": ["".join(draw.choices("abcd ", k=300))], "b": ["".join(draw.choices("cdef", k=200))],
                "c": ["katze"]}
    texts = ["katzexkatzex", "x", " x ", "katze"] + [
        "".join(draw.choices("abcdefx. ", weights=[5, 5, 5, 5, 5, 5, w, 1, 2], k=draw.randrange(1, 200)))
        for w in (0, 1, 5, 30) for _ in range(30)]
    for dense in (1 << 25, 0):
        model = build_model(training, dense=dense)
        _, _, bits = identify(model, model.symbols_of(), texts)
        for text, low in zip(texts, bits):
            parsed = symbols(text)
            costs = [phrases(parsed, symbols(t[0])) * math.log2(len(symbols(t[0]))) / len(parsed)
                     for t in training.values()]
            assert math.isnan(low) and not any(c.isalpha() for c in text) or math.isclose(min(costs), low)


def test_copies_do_not_drown_a_language(spark):
    rows = [(k, "the same old text over and over", "en", 0.0, "") for k in range(3000)]
    rows += [(5000 + k, f"der {k} hund und die katze", "de", 0.0, "") for k in range(300)]
    assert train(spark.createDataFrame(rows, SCHEMA)).languages == ["de", "en"]


def test_long_texts_are_learned_from_beyond_their_beginning(spark):
    rows = [(k, "a" * 3000 + f"bcdefg {k} " * 500, "xx", 0.0, "") for k in range(40)]
    model = train(spark.createDataFrame(rows, SCHEMA))
    assert set("abcdefg") <= set(model.alphabet)


def test_many_labels_are_learned_by_their_number_of_texts(spark, monkeypatch):
    import caseloom.llm.language as module

    monkeypatch.setattr(module, "MODEL_CHARS", 10 * module.LEAST_CHARS)
    rows = [(k, f"text number {j} of language {k}", f"l{k:02}", 0.0, "") for k in range(30)
            for j in range(1 + (k < 10))]
    model = train(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == [f"l{k:02}" for k in range(10)]
    assert module._plan([("a", 5)], 24_000)[1] == module.LEAST_CHARS * 10
    assert module._plan([], 24_000)[0] == []
