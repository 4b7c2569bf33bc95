import random
import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracemill.llm.bpe import ByteBPE, RankQueue, vocabulary_path
from tracemill.llm.endings import concluded, open_at_end, open_structures, terminated, without_mark
from tracemill.llm.p2_repetition import repeated_generations, repetition_measures
from tracemill.llm.p4_pairs import defect, defects, is_copy, is_cut_output, matches, tiles
from tracemill.llm.languages import Languages, counted, fitted
from tracemill.llm.refusals import declines
from tracemill.llm.p5_truncation import cut_generations, length_limits, trie, truncation_rates, vocabulary
from tracemill.llm.p6_leaks import leaked_items, searchers, words
from tracemill.llm.p8_encode import encode_corpus
from tracemill.llm.p9_mix import document_tokens, mix, mix_plan, reached_shares, unreachable

# --- repetition --------------------------------------------------------------------


def covered(text, n):
    w = re.findall(r"[^\W_]+", text.lower())
    seen, hit = set(), set()
    for i in range(len(w) - n + 1):
        gram = tuple(w[i : i + n])
        if gram in seen:
            hit.update(range(i, i + n))
        seen.add(gram)
    return len(w), len(hit), sum(len(w[i]) for i in hit)


def test_repetition_against_brute_force():
    rng = random.Random(1)
    alphabet = ["a", "b", "C", "é", "中", "1", "²", "_", "\n", "'", "😀"]
    texts = ["", " ", "\n\n", "a " * 5000] + [" ".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(200)]
    got = repetition_measures(texts, (1, 3, 6))
    for i, t in enumerate(texts):
        for n in (1, 3, 6):
            assert (got["n_words"][i], got[f"words_{n}"][i], got[f"chars_{n}"][i]) == covered(t, n)


def test_repeated_lines():
    got = repetition_measures(["One two\none, TWO!\nthree\n\nOne two", "One two"], (2,))
    assert got["n_lines"].tolist() == [4, 1] and got["lines_repeated"].tolist() == [2, 0]


def test_repeated_generations_at_the_threshold(spark):
    ten = "a b c d e f"  # six words again among twenty: 30 %
    rest = " ".join(f"x{i}" for i in range(8))
    df = spark.createDataFrame([(1, [f"{ten} {rest} {ten}", f"{ten} {rest} y {ten}", None, ""]), (2, None), (3, [])], "row_id bigint, generations array<string>")
    assert [tuple(r) for r in repeated_generations(df).collect()] == [(1, 0)]


# --- pairs ----------------------------------------------------------------------------

ASK = "A pump fills 388 litres in 584 minutes while a leak drains 917 litres each hour. After how many minutes does a tank overflow?"
SOLVED = "<think>\nThe pump gives 388 litres, so the rate is 0.66. We cannot divide by zero, but 584 is fine.\n</think>\n\nThe final answer is \\boxed{12}."


@pytest.fixture(scope="module")
def known(spark):
    return fitted(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.mark.parametrize(
    ("text", "short", "expected"),
    [
        (None, False, "empty_answer"), ("", True, "empty_answer"), ("​ \xa0", False, "empty_answer"), ("<think>\n\n</think>", False, "empty_answer"),
        ("\\boxed{}", True, "empty_answer"), ("N/A", True, "empty_answer"), ("$$", True, "empty_answer"), ("...", False, "empty_answer"),
        ("0", True, None), ("$\\infty$", True, None), ("∅", True, None), ("no solution exists", True, None), ("x = 5", True, None), ("\\frac{3}{4}", True, None),
        ("5\\sqrt{2}", True, None), ("The total comes to 108.", True, None), (SOLVED, False, None), ("Final answer: \\boxed{3}", False, None), ("**Answer:** 17", False, None),
        ("That settles it: z = 983, as required. QED", False, None),
        ("I'm sorry, but I am not able to solve this problem. Please ask something else.", False, "refusal"),
        ("You ask: A pump fills 388 litres in 584 minutes... Unfortunately, no answer will be given for this item.", False, "refusal"),
        ("Lo siento, pero no puedo ayudar con esta pregunta por ahora.", False, "refusal"), ("Je ne peux pas répondre.", True, "refusal"),
        ("Leider kann ich bei dieser Aufgabe nicht helfen.", False, "refusal"), ("我无法回答这个问题。", False, "refusal"),
        ("I cannot see 12 at first, but 388 - 376 = 12 after all, and 584 is larger than 388, hence 12 is right. The final answer is \\boxed{12}.", False, None),
        (ASK, False, "copied_question"), (f"Question: {ASK.lower()}", True, "copied_question"), (f"<think>\n{ASK}\n</think>\n\n{ASK}", False, "copied_question"),
        (ASK.replace("leak", "given"), False, "copied_question"), (f"{ASK}\n\nWe compute 584 * 2 = 1168 and 917 - 388 = 529, so the tank needs 77.\n\nFinal answer: \\boxed{77}", False, None),
        ("The pump fills 388 litres. Then the rate is 66 per hour, giv", False, "truncated"), ("The rate is 0.66. Row 445 has 645 \\frac{1", False, "truncated"),
        ("The total number of tiles is", True, "truncated"), ("6 + \\sqrt{", True, "truncated"), ("x = 3 and y =", True, "truncated"), ("\\frac{5}{", True, "truncated"), ("Adding 5 to (", True, "truncated"),
        ("La somme laisse 767, donc la borne dépasse 858.\n\nLa réponse finale est \\boxed{265}.", False, "wrong_language"), ("总数等于878。", True, "wrong_language"),
        ("Es sind insgesamt 133 Stück.", True, "wrong_language"), ("在626与955之间有583个值。 The sum of 3 and 4 is 7, which is the total that we have. Then the rest is of no use.\n\nSo the answer is \\boxed{7}", False, None),
    ],
)
def test_defects(known, text, short, expected):
    assert defect(text, ASK, short, known) == expected


def test_short_and_repeated_copies(known):
    copies = [("Compute 3+4", "Compute 3+4"), ("compute 3 + 4.", "Compute 3+4"), ("<think>\nCompute 3+4\n</think>\n\nCompute 3+4", "Compute 3+4"), ("\n\n".join([ASK] * 9), ASK), (" ".join([ASK.replace("leak", "given")] * 400), ASK)]
    assert [defect(text, ask, False, known) for text, ask in copies] == ["copied_question"] * 5
    assert not any(is_copy(text, ask) for text, ask in [("7", "Compute 3+4"), ("Compute 3-4", "Compute 3+4"), ("4", "4x"), ("x", " "), ("$", "7"), ("7", "<think>"), ("<think>", "7"), (f"{ASK} {SOLVED} " * 9, ASK)])


def test_defects_need_an_instruction(known):
    assert defect("La réponse est \\boxed{2}.", None, False, known) is None
    assert defect("La réponse est \\boxed{2}.", " ", False, known) is None


def test_languages(spark, known):
    texts = ("The sum of the numbers is of no use", "Die Summe der Zahlen ist gleich", "La suma es igual a la otra", "Le total est égal à la somme", "总数等于", "$x = 3$", "", "12")
    assert [known.of(s) for s in texts] == ["en", "de", "es", "fr", "zh", None, None, None]
    assert set(known.shares("The sum is even. La suma de los números es par.\n总数等于")) == {"en", "es", "zh"}
    labelled = [("EN ", "the remainder of the number is the sum of the parts " * 3)] * 5 + [("fr", "le reste du nombre est la somme des parties " * 3)] * 5
    wrong = counted([*labelled, ("fr", "the total of the numbers is the same " * 9), ("xx", "zz")])
    assert sorted(wrong) == ["en", "fr"] and Languages(wrong).of("the rest of the parts") == "en"
    none = fitted(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert none.of("the sum") is None and none.of("总数等于") == "zh"


def test_refusals_follow_the_grammar():
    good = ["I'm afraid I cannot do that.", "We cannot help with this request.", "Mi dispiace, ma non posso aiutarti.", "Desculpe, mas não posso responder a isso.", "Извините, я не могу помочь.", "Mi rifiuto di rispondere.", "Helaas kan ik deze vraag niet beantwoorden.", "Leider muss ich die Antwort ablehnen."]
    bad = ["We cannot divide by zero.", "No solution exists.", "x is not negative, so we can stop.", "Non si può dividere per zero.", "Man kann nicht durch null teilen.", "The rules of algebra keep the sign.", ""]
    assert all(map(declines, good)) and not any(map(declines, bad[:5] + bad[6:]))


def longest(text, pattern):
    out = []
    for i in range(len(text)):
        n = 0
        while any(pattern[j : j + n + 1] == text[i : i + n + 1] for j in range(len(pattern))) and i + n < len(text):
            n += 1
        out.append(n)
    return out


def test_tiles():
    assert tiles(list("abcxdefg"), list("abcdefg")) == [True, True, True, False, True, True, True, True]
    assert tiles(list("abab"), list("ab")) == [False] * 4
    assert tiles(list("abcabcab"), list("abc")) == [True] * 6 + [False] * 2
    rng = random.Random(8)
    for _ in range(300):
        text, pattern = rng.choices("abc", k=rng.randrange(20)), rng.choices("abc", k=rng.randrange(12))
        assert matches(text, pattern) == longest(text, pattern)
    many = tiles([str(i % 97) for i in range(200_000)], [str(i) for i in range(97)])
    assert all(many)


def test_defects_of_rows(spark):
    schema = "selected_id bigint, status string, instruction string, output string, answer string"
    df = spark.createDataFrame([(1, "ok", ASK, SOLVED, None), (1, "ok", ASK, SOLVED, None), (2, "judge_failed", None, None, None), (3, "ok", None, "x" * 200_000 + ".", "7")], schema)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert sorted(tuple(r) for r in defects(df, docs).collect()) == [(1, "answer", "empty_answer")] * 2


# --- endings and truncation --------------------------------------------------------------


def test_open_structures():
    assert open_structures("a $x$ (b) [c] {d} \\(e\\) ```f``` <b>g</b>") == []
    assert open_structures("a ($x") == ["(", "$"] and open_structures("\\frac{1") == ["{"] and open_structures("\\begin{align} x") == ["env align"]
    assert open_structures("``` ( $ ```") == [] and open_structures(") ] }") == [] and open_structures("\\{ \\$") == []


def test_structures_over_paragraphs():
    open_ = ["We run this code.\n\n```\nx = 1.\n\nThen we print it all and see what it is.", "See \\begin{align} x\n\nand y is the last of the values that we need.", "See $$ x = 1.\n\nThe rest of it is the same as it was before.", "We need two facts in all.\n1. The sum is 4.\n2.", "They say: “the sum of all of the columns is even.", "On lit : « la somme de toutes les colonnes est paire.", "Er sagt: »die Summe aller Spalten ist gerade."]
    whole = ["It costs $5 a day.\n\nSo $x = 3$ is the number of days that we have.", "```\nx = (1\n\ny = 2\n```", "The value lies in [0, 1) and is less than any of the others.", "Er sagt: „Die Summe ist gleich vier“ und geht dann wieder.", "Er sagt: »Die Summe ist gleich vier« und geht dann wieder.", "On lit : « la somme est paire » et rien de plus que cela.", "A list (of\n\nvalues that is followed by a text of its own.", "The number of all the days is\n12."]
    assert all(map(open_at_end, open_)) and not any(map(open_at_end, whole))
    assert all(map(is_cut_output, open_)) and not any(map(is_cut_output, [w for w in whole if w[0] != "`"]))


def test_an_open_structure_decides_before_a_full_stop(spark):
    texts = ["The sum is 4. Then we know that $x = 0.", "The sum is 4. Then we know (see the list at no.", "The sum is 4. Then we know that $x = 0$.", "The sum is 4.\n\n```\nx = 0."]
    df = spark.createDataFrame([(1, "s", texts)], "row_id bigint, source string, generations array<string>")
    assert sorted(r["gen_pos"] for r in cut_generations(df).collect()) == [0, 1, 3]
    assert [is_cut_output(t) for t in texts] == [True, True, False, True]


def test_open_markup_is_evidence(spark):
    plain = "first the remainder of the sum\nthen the total of the columns\nand the columns give the total"
    df = spark.createDataFrame([(1, "s", [plain, f"<think>\n{plain}", f"<think>\n{plain}\n</think>", f"<think>\n{plain}."])], "row_id bigint, source string, generations array<string>")
    assert [r["gen_pos"] for r in cut_generations(df).collect()] == [1]


def test_marks_and_conclusions():
    assert without_mark("half a wor [cut]") == ("half a wor", True) and without_mark("so on…") == ("so on", True) and without_mark("done.") == ("done.", False)
    assert terminated('He said "so."') and not terminated("and then") and not terminated("")
    good = ["So the answer is \\boxed{3}", "**Answer:** 17", "Antwort: 17.", "Thus we get 2. Answer: $\\boxed{2}$", "as required. QED", "Hence the result is 23."]
    assert all(map(concluded, good)) and not any(map(concluded, ["So the answer is \\boxed{3", "The term 301t cancels w", "giving we"]))


def test_vocabulary_and_trie(spark):
    df = spark.createDataFrame([("Counting words and counting wor",), (None,), ("",), ("words 12 count",)], "text string")
    seen = {r["word"]: r["n"] for r in vocabulary(df).collect()}
    assert seen == {"counting": 2, "words": 2, "and": 1}
    nodes = {r["node"]: r["below"] for r in trie(vocabulary(df)).collect()}
    assert nodes["wor"] == 2 and nodes["c"] == 2 and "words" not in nodes


def test_length_limits_show_as_spikes(spark):
    rows = [(n, False, True) for n in range(900, 1100)] + [(1000, False, False)] * 20
    df = spark.createDataFrame(rows, "length bigint, result boolean, ended boolean")
    assert [r["length"] for r in length_limits(df).collect()] == [1000]


def test_cut_generations(spark):
    whole = "The sum leaves a remainder of 4.\n\nHence the result is 23."
    texts = [whole, whole[:25], "The sum leaves 4. Then $x + ", "The sum leaves 4. We keep the rema…", whole + " ", None, "  ", "<think>\nThe sum is 4.\n</think>\n\nSo the answer is \\boxed{4}", "The sum is 4. So the answer is \\boxed{4", "Y" * 50_000]
    df = spark.createDataFrame([(1, "s", texts), (2, None, None), (1, "s", [whole[:25]])], "row_id bigint, source string, generations array<string>")
    assert sorted(tuple(r) for r in cut_generations(df).collect()) == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 8), (1, 9)]
    assert [tuple(r)[:3] for r in truncation_rates(df).collect()] == [("s", 9, 6)]


def test_the_trie_decides_where_no_sentence_end_is_due(spark):
    plain = "first the remainder of the sum\nthen the total of the columns\nand the columns give the total"
    items = "We need two facts.\n\n- the remainder of the sum\n- the total of the columns"
    label = "The total has a remainder.\n\nAnswer: the remainder"
    texts = [plain, plain[:-2], items, items[:-3], label, label[:-4], "## The remainder", "The total is 4. Then the remainder", "Answer: tot", "Then we see this. Answer: tot", plain + " and the"]
    df = spark.createDataFrame([(1, "s", texts)], "row_id bigint, source string, generations array<string>")
    assert sorted(r["gen_pos"] for r in cut_generations(df).collect()) == [1, 3, 5, 7, 10]


# --- leaks -----------------------------------------------------------------------------


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    vocab = ["a", "b", "c", "dd", "ee"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 2, 3, 5, 11, 12, 13, 20])))) for i in range(60)] + [(99, None), (98, "$ !")]
    texts = [(i, ", ".join(rng.choices(vocab, k=rng.randrange(40))).upper()) for i in range(120)] + [(500, None), (501, ""), (1, items[8][1])]
    texts += [(600 + i, f"x {t} y") for i, t in items if t]

    def contains(text, item):
        w, p = words(text), words(item)
        size = min(12, len(p))
        grams = {tuple(p[i : i + size]) for i in range(len(p) - size + 1)} if p else set()
        return any(tuple(w[i : i + size]) in grams for i in range(len(w) - size + 1)) if size else False

    expected = sorted((i, j) for i, t in texts for j, p in items if t and p and contains(t, p))
    corpus = spark.createDataFrame(texts, "row_id bigint, problem string")
    bench = spark.createDataFrame(items, "item_id bigint, problem string")
    assert sorted(tuple(r) for r in leaked_items(corpus, bench, "row_id", "problem").collect()) == expected
    assert sorted(tuple(r) for r in leaked_items(corpus, bench, "row_id", "problem", words_at_once=2000).collect()) == expected
    assert searchers([(1, None)], 12) == []


# --- tokens ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def public():
    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_public_encoder(public):
    bpe = ByteBPE(vocabulary_path())
    rng = random.Random(5)
    parts = ["the", "The", " ", "  ", "\n", "\r\n", "\t", "1", "2023", "'s", "'ll", "é", "中文", "😀", "\xa0", "​", "\x1c", "\x85", "<|endoftext|>", "²", "　", "!", "--", "_", "\\frac{", "x" * 40]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(30)))
        ids = bpe.encode(text)
        assert ids == public.encode(text, add_special_tokens=False).ids
        assert bpe.count(text) == len(ids)
        assert b"".join(bpe.token[i] for i in ids).decode() == text
    assert bpe.encode(None) == bpe.encode("") == [] and bpe.count(None) == 0


def test_long_pretokens_are_linear(public):
    bpe = ByteBPE(vocabulary_path())
    for text in ("ab" * 50_000, "a" * 100_001, "abcab" * 20_000):
        assert bpe.encode(text) == public.encode(text, add_special_tokens=False).ids


def test_rank_queue_pops_in_order():
    rng = random.Random(6)
    queue, given = RankQueue(50_257), {}
    for p in range(5000):
        r = rng.randrange(50_257)
        queue.push(r, p)
        given.setdefault(r, []).append(p)
    out = []
    while (least := queue.pop()) is not None:
        out.append(least)
    assert out == sorted(given.items())


def test_caches_stay_bounded():
    bpe = ByteBPE(vocabulary_path(), cache_entries=50)
    for i in range(500):
        bpe.encode(f"word{i} x")
    assert len(bpe._pieces) <= 52 and len(bpe._pretokens) <= 52


def test_long_pieces_are_not_kept(public):
    bpe = ByteBPE(vocabulary_path())
    text = "x" * 100 + " " + "ab" * 500_000 + " end"
    ids = bpe.encode(text)
    assert ids == public.encode(text, add_special_tokens=False).ids and bpe.count(text) == len(ids)
    assert max(map(len, [*bpe._pieces, *bpe._pretokens, *bpe._lengths])) <= 64


def test_encode_corpus(spark):
    df = spark.createDataFrame([(1, "the cat", "x"), (2, None, "x"), (3, "", "x"), (None, "a", "x"), (1, "the cat", "x")], "doc_id bigint, text string, ids string")
    got = encode_corpus(df)
    assert got.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    assert sorted(((r["doc_id"] or 0), r["ids"]) for r in got.collect()) == [(0, [64]), (1, [1169, 3797]), (1, [1169, 3797]), (2, []), (3, [])]


# --- mixing ---------------------------------------------------------------------------------


def test_shares_count_each_document_once(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "c", "t")], "doc_id bigint, text string, source string")
    shares = reached_shares(docs, spark.createDataFrame([("s", 0.5, 1), ("t", 0.5, 1)], "source string, target_share double, max_repeats int"))
    assert "Python" not in shares._jdf.queryExecution().executedPlan().toString()


def test_mix_reaches_the_shares(spark):
    docs = [(i, "word " * 10, "big") for i in range(2000)] + [(5000 + i, "word " * 10, "small") for i in range(200)] + [(9000 + i, "word " * 10, "tiny") for i in range(10)] + [(1, "word", None), (2, None, "big"), (3, "word " * 10, "other")]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.2, 3), ("tiny", 0.1, 2), ("none", 0.1, 5), (None, 0.0, 1)], "source string, target_share double, max_repeats int")
    assert sorted(r["source"] for r in unreachable(docs, targets).collect()) == ["none", "tiny"]
    plan = {r["source"]: r for r in mix_plan(document_tokens(docs, targets), targets).collect()}
    assert plan["small"]["rate"] == pytest.approx(2.21, abs=0.02) and plan["tiny"]["rate"] == 2.0 and plan["none"]["tokens"] == 0
    drawn = mix(docs, mix_plan(document_tokens(docs, targets), targets))
    copies = {r["source"]: r["n"] for r in drawn.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert copies["tiny"] == 20 and copies["small"] == pytest.approx(442, rel=0.06) and copies["big"] == pytest.approx(1326, rel=0.06) and set(copies) == {"big", "small", "tiny"}
    assert drawn.collect().sort() == mix(docs.repartition(7), mix_plan(document_tokens(docs, targets), targets)).collect().sort()
    shares = {r["source"]: r["mixed_share"] for r in reached_shares(docs, targets).collect()}
    assert sum(shares.values()) == pytest.approx(1.0) and shares["none"] == 0.0
