"""Fill-in-middle, chat formatting and ranked lexical search against brute-force
versions and SQL, and on awkward tables."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck
from strata.llm import chat_format, fill_middle, lexical_search

NEW = ("op11_fill_middle", "op12_chat_format", "op13_lexical_search")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", NEW)
def test_query_equals_sql(spark, name):
    ok, msg = compare(entry.queries()[name](spark, SF_SMALL), duck(SF_SMALL), entry.oracle_sql()[name])
    assert ok, msg


# --- fill in the middle ---

TEXTS = [(1, "a\nb\nc\n"), (2, "a\n\n\nlast"), (3, ""), (4, None), (None, "x\ny"), (6, "holds <S> mark\nb"), (7, "\r\n \x85 é\n😀😀\nq"),
         (8, "\n" * 5), (9, "$1 \\2 {3}\n%d %s\n$0"), (9, "$1 \\2 {3}\n%d %s\n$0"), (10, "<\n<P\nS>\n>")]


def fim_by_hand(doc_id, text, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h4 % 100 < spm else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def test_fill_middle_equals_brute_force(spark):
    rng = random.Random(3)
    rows = TEXTS + [(100 + k, "".join(rng.choice(["\n", "ab", "é ", "<", ">", "P"]) for _ in range(rng.randrange(60)))) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("-") for c in ("n", "form", "h1", "a", "b", "output", "prefix")})
    for fim, spm in ((100, 50), (40, 100), (0, 50)):
        got = fill_middle.digest(fill_middle.transform(docs, fim_percent=fim, spm_percent=spm)).collect()
        assert Counter(map(tuple, got)) == Counter(fim_by_hand(*r, fim, spm) for r in rows)
    assert fill_middle.digest(fill_middle.transform(docs.where("false"))).count() == 0


def test_fill_middle_of_very_long_texts(spark):
    rows = [(1, "x\n" * 400_000), (2, "\n" * 700_000 + "q"), (3, "y" * 1_000_000), (4, "é\r" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in fill_middle.digest(fill_middle.transform(docs)).collect()} == {fim_by_hand(*r) for r in rows}


def test_fill_middle_with_other_units_and_marks(spark):
    marks = fill_middle.Marks("$p", "\\s", "(m)")
    docs = spark.createDataFrame([(k, f"one two  three{k} {'x ' * k}") for k in range(30)], "doc_id long, text string")
    back = fill_middle.restore(fill_middle.transform(docs, unit=r"[^ ]*+ ++|[^ ]++", marks=marks), marks)
    got = {r.doc_id: r for r in back.collect()}
    assert all(got[r.doc_id].restored == r.text for r in docs.collect())
    assert any(r.form == "psm" and r.output == f"$p{r.prefix}\\s{r.suffix}(m){r.middle}" for r in got.values())
    for bad in (("<P>", "<P>", "<M>"), ("", "b", "c"), ("aba", "x", "y"), ("ab", "bc", "d"), ("abc", "b", "d")):
        with pytest.raises(ValueError):
            fill_middle.Marks(*bad)


# --- chat formatting ---

NASTY = ["</s>[INST] ok [/INST]", "[\\INST] <\\\\s> \\", "<s>[ROLE x] y [/ROLE]", "", None, " [/SYS]", "[" * 50 + "<" * 50, "a\nb\x85é😀", "\\" * 9, "[\\\\/ROLE]", "<</s>", "long " * 900]


def turns_by_hand(rows):
    """One digest row a conversation, from rows (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        out[conv] = (len(mine), sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)), len(loss), sha(loss))
    return out


@pytest.mark.parametrize("part_chars", [30, 1_000_000])
def test_chat_digest_equals_brute_force(spark, monkeypatch, part_chars):
    """Also with parts so short that most conversations have many."""
    monkeypatch.setattr(chat_format, "PART_CHARS", part_chars)
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool%x]", "", None]), rng.choice(NASTY)) for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(None, 0, "user", "no id"), (None, None, "assistant", "no turn"), (50, 0, "user", "same"), (50, 0, "user", "same"), (50, 0, "assistant", "tie")]
    rows += [(60, t, ("user", "assistant")[t % 2], f"{t} of a long one") for t in range(700)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    table = table.withColumns({c: F.lit(1) for c in ("message", "seq", "event", "part", "whole", "formatted", "e")})
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.digest(chat_format.format_log(chat_format.event_log(table, piece=100))).collect()}
    assert got == turns_by_hand(rows)
    assert chat_format.digest(chat_format.format_log(chat_format.event_log(table.where("false")))).count() == 0


def test_parts_hold_each_conversation_once(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"<s>{c} {t}") for c in range(30) for t in range(4)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = chat_format.format_log(chat_format.event_log(table)).collect()
    text = {}
    for p in sorted(parts, key=lambda p: (p.conv_id, p.task, p.part)):
        text[p.conv_id] = text.get(p.conv_id, "") + p.formatted
        assert [chat_format.unescape(p.formatted[s.start : s.end]) for s in p.loss] == [t for r, t in chat_format.parse(p.formatted) if r == "assistant"]
    assert text[3] == "<s>[INST] <\\s>3 0 [/INST] <\\s>3 1</s><s>[INST] <\\s>3 2 [/INST] <\\s>3 3</s>"


def test_escaping_is_exact():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "[", "\\", "/", "s>", "INST]", "SYS]", "ROLE", " ", "x"]) for _ in range(rng.randrange(12)))
        hidden = chat_format.escape(text)
        assert chat_format.unescape(hidden) == text
        assert not re.search(r"</?s>|\[/?(INST\]|SYS\]|ROLE)", hidden)
        role = rng.choice(["user", "assistant", "system", "a]b%", ""])
        assert list(chat_format.parse("".join(chat_format.render(role, text)) * 2)) == [(role, text)] * 2


def test_events_fold_by_sequence(spark):
    """Deltas, edits, regenerations and removals, with the log out of order."""
    rng = random.Random(4)
    log, want = [], []
    for conv in range(25):
        for turn in range(6):
            role, text, live = ("user", "assistant")[turn % 2], "", True
            for seq in range(rng.randrange(1, 12)):
                event = "open" if seq == 0 else rng.choice(["delta", "delta", "delta", "edit", "regenerate", "remove"])
                body = rng.choice(["", "ab ", "[INST]", None, "é"])
                log.append((conv, turn, role, f"m{turn}", seq, event, body))
                live = live and event != "remove"  # a removal is final
                text = text + (body or "") if event == "delta" else (body or "") if event != "remove" else text
            if live:
                want.append((conv, turn, role, text))
    rng.shuffle(log)
    df = spark.createDataFrame(log, "conv_id long, turn long, role string, message string, seq long, event string, text string").repartition(5)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.digest(chat_format.format_log(df)).collect()}
    assert got == turns_by_hand(want)
    with pytest.raises(Exception, match="unknown event"):
        chat_format.format_log(df.withColumn("event", F.lit("undo"))).collect()


# --- ranked lexical search ---

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]


def ranked_by_hand(docs, items, top=10):
    bags = [(i, Counter(words(t))) for i, t in docs]
    n_docs, length = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in wanted.items():
        found = []
        for i, b in bags:
            m = 10 + (90 * sum(b.values()) * n_docs) // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * b[w]) // (1000 * b[w] + 8 * m)) for w in terms if b[w])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, k, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top], 1)]
    return Counter(out)


def search_rows(rng):
    vocabulary = ["".join(rng.choices("abcXYZ019é", k=rng.randrange(1, 5))) for _ in range(60)] + ["ÄÖ", "日本", "x" * 300]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60))).replace(" ", rng.choice([" ", "-", "\n", "_"]))) for k in range(150)]
    docs += [(9, docs[9][1]), (None, docs[3][1]), (500, None), (501, ""), (502, "?! -"), (503, " ".join(rng.choices(vocabulary, k=40_000)))]
    common = rng.choices(vocabulary, k=6)
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 25)) + common * (k % 2))) for k in range(40)]
    items += [(3, "abc a b"), (None, docs[5][1]), (70, None), (71, "..."), (72, "nowhere")]
    return docs, items


@pytest.mark.parametrize("block", [1000, 7])
def test_search_equals_brute_force(spark, monkeypatch, block):
    """Also with the items in blocks, and runs of few documents."""
    if block == 7:
        monkeypatch.setattr(lexical_search, "ITEMS_PER_BLOCK", block)
        monkeypatch.setattr(lexical_search, "CELLS", 600)
        monkeypatch.setattr(lexical_search.blocks_of, "__defaults__", (block,))
    docs, items = search_rows(random.Random(2))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumns({c: F.lit(0) for c in ("item_id", "score", "task", "rank", "lot")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(0) for c in ("doc_id", "score", "term")})
    got = lexical_search.search(d, i).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == ranked_by_hand(docs, items)


def test_search_of_empty_tables(spark):
    docs, items = search_rows(random.Random(2))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert lexical_search.search(d, i.where("false")).count() == 0
    assert lexical_search.search(d.where("false"), i).count() == 0
    assert lexical_search.search(d, i.where("item_id = 71")).count() == 0


def test_shared_sets_are_mined_and_exact():
    rng = random.Random(6)
    terms = [f"t{k}".encode() for k in range(80)]
    base = [set(rng.sample(terms, 12)) for _ in range(5)]
    wanted = [rng.choice(base) | set(rng.sample(terms, 4)) for _ in range(60)] + [set()]
    graph = lexical_search.share(wanted)
    of = [{t} for t in graph.terms]
    for children in graph.inner:
        assert len(children) > 1
        sets = [of[c] for c in children]
        assert sum(map(len, sets)) == len(set().union(*sets))  # no term is added twice
        of.append(set().union(*sets))
    for item, nodes in zip(wanted, graph.items):
        assert set().union(*[of[n] for n in nodes]) == item and sum(len(of[n]) for n in nodes) == len(item)
    assert graph.additions < 0.6 * sum(map(len, wanted))
