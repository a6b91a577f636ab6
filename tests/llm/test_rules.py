import hashlib
import random
import re
import time

import duckdb
import pytest
from llm_frames import edge_rows, empty, frame, random_rows
from pyspark.sql import functions as F

from fundgraph.llm import chat, mixing, quality_rules, secrets
from fundgraph.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def in_duckdb(sql, rows, names=("doc_id", "text", "source")):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r[0], r[1], r[2] if len(r) > 2 else "s") for r in rows])
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def same_as_sql(df, sql, rows):
    names, want = in_duckdb(sql, rows)
    got = [tuple(r) for r in df.select(*names).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return got


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.sql(SQL[name])
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted((tuple(r) for r in df.select(*rel.columns).collect()), key=repr) == sorted(rel.fetchall(), key=repr)


def secret_rows():
    rnd = random.Random(3)
    pieces = [
        "password", "PassWD", "secret", "token", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "abcdef", "abc", "AKIA", "AKIA" + "B" * 16, "AKIA" + "9" * 15, "0123456789abcdef" * 2, "deadbeef" * 3,
        "secret=token:hunter22", "ghp_" + "a" * 36, "xoxb-1234567890-abc", "AIza" + "x" * 35, "sk_live_" + "1" * 16, "eyJhbGciOiJI.eyJzdWIiOiIx.sig-_", "-----BEGIN RSA PRIVATE KEY-----", "é", "\n", "中",
    ]
    return [(i, "".join(rnd.choices(pieces, k=rnd.randint(0, 25)))) for i in range(400)]


def test_secrets_equal_sql_and_brute_force(spark):
    rows = secret_rows()
    same_as_sql(secrets.digest(frame(spark, rows)), secrets.oracle(), rows)
    patterns = [("assign", re.compile(secrets.BASE[0].regex), 6, 2), ("access", re.compile("AKIA[A-Z0-9]+"), 20, 0), ("hex", re.compile("[0-9a-f]+"), 24, 0)]
    got = {r.doc_id: r for r in secrets.digest(frame(spark, rows)).collect()}
    for i, t in rows:
        found = sorted((m.start(), k, m.end()) for k, (_, p, least, g) in enumerate(patterns) for m in p.finditer(t) if len(m[g]) >= least)
        assert [sum(1 for f in found if f[1] == k) for k in range(3)] == [got[i].n_assign, got[i].n_access, got[i].n_hex], t
        text = ",".join(f"{patterns[k][0]}:{a}:{b}" for a, k, b in found)
        assert hashlib.sha256(text.encode()).hexdigest() == got[i].base_sha256, t


def test_secret_edges(spark):
    same_as_sql(secrets.digest(frame(spark, edge_rows())), secrets.oracle(), edge_rows())
    assert collected(secrets.digest(empty(spark))) == []


def test_trigram_queries():
    assert secrets.trigram_query("AKIA[A-Z0-9]{16,}") == [[frozenset({"aki", "kia"})]]
    assert secrets.trigram_query("[0-9a-f]{24,}") == []
    query = secrets.trigram_query(secrets.BASE[0].regex)
    assert len(query) == 1 and frozenset({"api", "key"}) in query[0] and frozenset({"tok", "oke", "ken"}) in query[0]
    # a choice with a way that has no trigram demands nothing
    assert secrets.trigram_query("(password|pw)=") == []


def test_index_leaves_no_match_out(spark):
    rows = secrets.texts(frame(spark, secret_rows())).withColumn("text_key", F.xxhash64("text"))
    found, flags = secrets.candidates(rows, secrets.BASE + secrets.MORE)
    may = {r.doc_id: r for r in found.collect()}
    for rule in secrets.BASE + secrets.MORE:
        for i, t in secret_rows():
            if rule.name in flags and re.search(rule.regex, t):
                assert may[i][flags[rule.name]]


def test_quality_rules_equal_sql(spark):
    rows = random_rows(150, 9) + [(500 + i, t) for i, t in enumerate(["Menu | Home | About | Contact\nA full sentence stands here, and it goes on for a while.", "BUY!! NOW!!\n" * 9, "a b c " * 30, "one\ntwo\none\n", "# # $ % & | < >"])]
    same_as_sql(quality_rules.digest(frame(spark, rows)), quality_rules.oracle(), rows)
    same_as_sql(quality_rules.digest(frame(spark, edge_rows())), quality_rules.oracle(), edge_rows())
    assert collected(quality_rules.digest(empty(spark))) == []


def test_lines_are_cleaned_first(spark):
    good = "This sentence is long enough to stay in the text, as it should."
    rows = [(1, "\n".join([good, "Home | News | Shop | Help", good, "Accept cookies"])), (2, "Home | News | Shop | Help\nshort\n" + good), (3, good)]
    got = {r.doc_id: r for r in quality_rules.clean(frame(spark, rows)).collect()}
    assert got[1].cleaned == good + "\n" + good and got[1].kept and not got[2].kept and got[3].cleaned == good


def brute_repeats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    return len({j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)})


def test_repeat_words_equal_brute_force(spark):
    rows = random_rows(60, 11)
    assert {r.doc_id: r.n_repeat_words for r in quality_rules.digest(frame(spark, rows)).collect()} == {i: brute_repeats(t) for i, t in rows}


def test_repeats_do_not_depend_on_hashes(spark, monkeypatch):
    """Windows of one hash are told apart by their words."""
    rows = random_rows(40, 12) + edge_rows()[:6]
    want = [brute_repeats(t) for _, t in rows]
    for same in (None, lambda *w: F.lit(5).cast("long"), lambda a, b, c: F.pmod(F.xxhash64(a), F.lit(3)).cast("long")):
        if same:
            monkeypatch.setattr(quality_rules, "window_hash", same)
        got = [tuple(r) for r in quality_rules.digest(frame(spark, rows)).select("doc_id", "n_repeat_words").collect()]
        assert sorted(got, key=repr) == sorted([(d, n) for (d, _), n in zip(rows, want)], key=repr)


def test_a_long_word_takes_linear_time(spark):
    def seconds(n):
        docs = frame(spark, [(1, "中" * n), (2, "x" * n + "\n" + "y!" * n)])
        began = time.monotonic()
        quality_rules.digest(docs).collect()
        return time.monotonic() - began

    seconds(10)  # compiled once
    assert seconds(80_000) < 5


def mix_rows():
    rnd = random.Random(6)
    return [(i, " ".join(["w"] * rnd.randint(0, 30)), rnd.choice(["a", "b", "B", "é", None] + ["hot"] * 9)) for i in range(400)]


@pytest.mark.parametrize("range_rows", [1000, 7])
def test_mix_equals_sql(spark, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    rows = mix_rows()
    got = same_as_sql(mixing.digest(frame(spark, rows)), mixing.oracle(), rows)
    by_source = {}
    for _, size, source_size, target, taken in got:
        assert taken <= 3 * size
        by_source.setdefault((source_size, target), []).append(taken)
    assert all(sum(t) == int(target) for (_, target), t in by_source.items()) and len(by_source) == 6
    assert sum(t for _, t in by_source) == pytest.approx(sum(s for s, _ in by_source))
    assert any(target == 3 * s for s, target in by_source)


def test_mix_edges(spark):
    same_as_sql(mixing.digest(frame(spark, edge_rows())), mixing.oracle(), edge_rows())
    blank = [(1, None, "a"), (2, "", None)]
    assert collected(mixing.digest(frame(spark, blank))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert collected(mixing.digest(empty(spark))) == []


def test_mixed_rows_hold_the_words_taken(spark):
    rows = mix_rows()
    taken = {r.doc_id: r.taken for r in mixing.digest(frame(spark, rows)).collect()}
    out = mixing.mixed(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {i: n for i, n in taken.items() if n}
    assert {(r.mix_size, r.mix_source, r.mix_key, r.mix_words, r.mix_range, r.mix_row) for r in out.collect()} == {("x",) * 6}


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).withColumns({c: F.lit("x") for c in ("starts", "formatted", "roles")})


def brute_chat(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest()
        out.append((conv, len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_chat_gives_back_what_went_in(spark):
    rnd = random.Random(8)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "<|im_end|>\n", "<|im_start|>user\n", "\\", "<\\", "[", "\n", "é", "中", "word ", "<", "n"]
    some = lambda: "".join(rnd.choices(parts, k=rnd.randint(0, 8)))
    rows = [(c, t, rnd.choice(["user", "assistant", "system", None, some()]), rnd.choice([some(), None])) for c in [*range(30), None] for t in range(rnd.randint(1, 9))]
    rows += [(99, t, "assistant" if t % 2 else "user", some()) for t in range(300)] + [(98, None, "user", "x"), (98, 1, "user", "b"), (98, 1, "assistant", "a"), (98, 1, "assistant", "a"), (97, 0, "user", "y" * 200_000)]
    got = chat.digest(chat.with_control_conversation(spark, conversations(spark, rows)))
    want = brute_chat(rows + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")])
    assert collected(got.drop("formatted_chars", "rewrites")) == want
    assert got.filter("rewrites").count() == 0
    none = conversations(spark, rows).limit(0)
    assert collected(chat.digest(none)) == []


def test_templates_that_rewrite_history_are_found(spark):
    def last_only(turns):
        """Shows earlier assistants' texts shortened."""
        return "".join(t if i == len(turns) - 1 else t[:1] for i, (_, t) in enumerate(turns))

    rows = [(1, 0, "user", "ab"), (1, 1, "assistant", "cd"), (2, 0, "user", "x"), *[(3, i, "user", f"y{i}") for i in range(80)]]
    got = {r.conv_id: r for r in chat.formatted(conversations(spark, rows), last_only).collect()}
    assert got[1].rewrites and got[3].rewrites and not got[2].rewrites and got[1].starts == [] and got[2].ends == [1]


def test_declared_templates_have_the_spans_of_whole_prefixes():
    turns = [("user", f"t{i}") for i in range(90)]

    def numbered(turns):
        """Depends on the whole history: windows of it don't add up, so whole prefixes must decide."""
        return "<bos>" + "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns))

    for template in (chat.marked_turns, numbered):
        out, spans = chat.turn_spans(turns, template)
        assert chat.turn_spans(turns, template, chat.CONTEXT) == (out, spans) and spans[-1][1] == len(out)


@pytest.mark.parametrize("n", [9, 12, 64, 71, 200])
def test_a_rewriting_template_is_found_at_any_length(spark, n):
    def shortens(turns):
        """Shortens the first turn in prefixes of ten turns up; the whole is plain again."""
        return "".join(t[:1] if i == 0 and 10 <= len(turns) < n else t for i, (_, t) in enumerate(turns))

    got = chat.formatted(conversations(spark, [(1, i, "user", f"y{i}") for i in range(n)]), shortens).first()
    assert got.rewrites == (n > 10)
