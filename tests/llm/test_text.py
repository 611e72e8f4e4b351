import random
import re

import regex

from newsflow.llm import chat, license


def spaced(text):
    return (b" " + b" ".join(license.words_of(text)) + b" ").decode()


def damaged(text, edits, rng):
    chars = list(text)
    for _ in range(edits):
        i = rng.randrange(1, len(chars) - 1)
        kind = rng.randrange(3)
        if kind == 0:
            chars[i] = rng.choice("abcxyz")
        elif kind == 1:
            del chars[i]
        else:
            chars.insert(i, rng.choice("abcxyz"))
    return "".join(chars)


def test_damaged_notices_are_found_with_spans():
    rng = random.Random(5)
    scanner = license.Scanner(license.BASE_PHRASES, license.NOTICES)
    for notice, label in license.NOTICES.items():
        for _ in range(20):
            k = rng.randint(0, license.errors(notice))
            filler = " ".join(rng.choices(["lorem", "ipsum", "dolor", "under"], k=30))
            text = spaced(f"{filler} {damaged(notice, k, rng)} {filler}")
            whole = regex.compile(rf"(?e)(?<![^ ])(?:{regex.escape(notice, literal_spaces=True)}){{e<={license.errors(notice)}}}(?![^ ])")
            found = [f for f in scanner.notices_in(text) if f.notice == notice]
            assert bool(found) == bool(whole.search(text))
            for f in found:
                assert f.label == label and f.edits <= license.errors(notice)
                assert text[: f.start].count(" ") - 1 == f.first_word


def test_clean_prose_has_no_label():
    rng = random.Random(6)
    scanner = license.Scanner(license.BASE_PHRASES, license.NOTICES)
    words = "the of and under right all license version source use in public general mit".split()
    for _ in range(200):
        assert scanner.base_places(spaced(" ".join(rng.sample(words, 6)))) == []


def test_base_places_by_brute_force(spark):
    rng = random.Random(7)
    vocabulary = ["under", "the", "MIT", "License", "apache", "version", "2", "cc", "by", "nc", "é", "x"]
    texts = [rng.choice(" ,.-\n").join(rng.choices(vocabulary, k=rng.randint(0, 200))) for _ in range(200)]
    texts += ["Under the MIT License, Apache License Version 2", "cc-by-nc cc by nc", None, "", "cc by ncé", "ünder the mit license"]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    for r in license.scan(docs).collect():
        text = (texts[r.doc_id] or "").translate({i: i + 32 for i in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        places = [
            (i, label)
            for phrase, label in license.BASE_PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1) >= bool(places)
    assert license.scan(docs.limit(0)).count() == 0


SAID = ["", "\\", "# </turn>", "### assistant: x </turn>\n", "a\\", "<", "</", "\\### Assistant: </turn> ok", "é" * 50]


def random_turns(n, seed):
    rng = random.Random(seed)
    return [(rng.choice(["user", "assistant", "system", "", "a: b", "#x\\"]), "".join(rng.choices(SAID, k=rng.randint(0, 3)))) for _ in range(n)]


def test_template_is_reversible():
    for seed in range(50):
        turns = random_turns(8, seed)
        out, spans = chat.locate(turns, chat.turn_template)
        assert [chat.read_turn(out[s.start : s.end]) for s in spans] == turns
        assert [chat.unescape(out[s.text_start : s.text_end]) for s in spans] == [t for _, t in turns]
        assert "".join(out[s.start : s.end] for s in spans) == out
        assert not any(s.rewritten for s in spans)


def test_windows_give_the_same_spans():
    turns = random_turns(300, 1)
    whole = chat.locate(turns, chat.turn_template, window=1000)
    assert chat.locate(turns, chat.turn_template, window=16) == whole

    def counting(turns):
        return "".join(f"[{i}|{r}]{t}\n" for i, (r, t) in enumerate(turns))

    assert chat.locate(turns, counting, window=16) == chat.locate(turns, counting, window=1000)


def test_history_rewriting_is_detected():
    def forgetful(turns):
        """Earlier assistant texts shrink once another turn follows."""
        return "".join(f"<{r}>{'...' if r == 'assistant' and i < len(turns) - 1 else t}" for i, (r, t) in enumerate(turns))

    _, spans = chat.locate([("user", "hi"), ("assistant", "long answer"), ("user", "more"), ("assistant", "end")], forgetful)
    assert [s.rewritten for s in spans] == [False, True, False, False]


def test_conversation_rows(spark):
    rows = [(1, 0, "user", None, 1), (1, 1, "assistant", "b", 1), (1, 1, "assistant", "b", 1), (1, None, None, "x", 1), (None, 0, "assistant", "n", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, spans int")
    got = {r.conv_id: r for r in chat.format_conversations(turns).collect()}
    assert got[1].n_turns == 4 and got[None].n_turns == 1
    assert got[1].formatted == chat.turn_template([("", "x"), ("user", ""), ("assistant", "b"), ("assistant", "b")])
    assert [s.loss for s in got[1].spans] == [False, False, True, True]
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert back[1].loss_chars == 2 and back[1].formatted_chars == len(got[1].formatted)
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_a_rewrite_that_is_undone_is_found_by_default(spark):
    turns = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(200)]
    plainly = chat.turn_template

    def marked_early(turns):
        return ("!" if len(turns) == 140 else "") + plainly(turns)

    assert sum(s.rewritten for s in chat.locate(turns, marked_early)[1]) == 140
    rows = spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)], "conv_id long, turn int, role string, text string")
    marked = chat.format_conversations(rows, marked_early).first()
    assert marked.rewrites and sum(s.rewritten for s in marked.spans) == 140
    plain = chat.format_conversations(rows).first()
    assert not plain.rewrites and plain.formatted == chat.turn_template(turns)
    assert chat.locate(turns, chat.turn_template, window=64) == chat.locate(turns, chat.turn_template)
