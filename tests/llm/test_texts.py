"""Chat formatting, secret scan, BPE and licences against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinship.llm import chat, license_rules, license_scan, ngram_quality, queries, secret_scan, word_bpe

CHAT = "conv_id long, turn long, role string, text string"


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# Chat


def chat_rows():
    pieces = ["<", "|", "\\", "<|", "<|im_end|>", "<|im_start|>", "im_end", "<|n|>", "\n", "a", "é", "<\\|", "\x00"]
    rng = random.Random(5)
    rows = [
        (c, t, rng.choice(["user", "assistant", "sys\ntem", "<|im_start|>", None]), "".join(rng.choices(pieces, k=rng.randint(0, 9))))
        for c in range(60)
        for t in range(rng.randint(1, 6))
    ]
    return rows + [(100, 0, "user", None), (101, None, "user", "x"), (101, 1, "assistant", "y"), (None, 0, "user", "z")] + [
        (102, 1, "user", "b"), (102, 1, "user", "a"), (102, 1, "assistant", "a"), (103, 0, "assistant", "t" * 200_000)
    ]


def test_chat_reads_back_what_was_said(spark):
    rows = chat_rows()
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(spark.createDataFrame(rows, CHAT).withColumn("rendered", F.lit(1)))).collect()}
    said = defaultdict(list)
    for c, turn, role, text in rows:
        said[c].append((turn is not None, turn or 0, role or "", text or ""))
    assert got.keys() == said.keys()
    for c, turns in said.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_spans_and_escapes(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <|im_end|> b"), (1, 2, "assistant", "plain")]
    r = chat.format_conversations(spark.createDataFrame(rows, CHAT)).first()
    spans = [r["formatted"][s["start"] : s["end"]] for s in r["loss_spans"]]
    assert spans == ["a <\\|im_end|> b", "plain"] and r["n_escaped"] == 1
    assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == 3


def test_chat_of_nothing(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], CHAT))).count() == 0


# Secrets


def brute_secrets(text):
    found = []
    for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[1]) >= 12:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secrets_base_equals_brute_force(spark, small):
    docs = small("documents")
    extra = ["token=secret=abcdefghijklmnop", "PassWord : 'ABCDEFGHIJKL", "api_key=short", "é AKIA12345678901234 f" + "0" * 40]
    docs = docs.select("doc_id", "text", "source").unionByName(
        spark.createDataFrame([(10_000 + i, t, "s") for i, t in enumerate(extra)], "doc_id long, text string, source string")
    )
    got = by_id(secret_scan.digest(secret_scan.scan(docs)))
    for r in docs.collect():
        spans = brute_secrets(r["text"] or "")
        joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
        row, kinds = got[r["doc_id"]], Counter(s[2] for s in spans)
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [kinds["assign"], kinds["access"], kinds["hex"]]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))


def test_secrets_by_ownership(spark):
    copied, own = "token=examplekey1234567", "token=Zk3v9QpL7xWt2BnR"
    rows = [(i, f"see {copied} here", f"s{i}") for i in range(5)] + [(9, own, "s1"), (10, own, "s1"), (11, own + " x", None), (12, "token=zzzzzzzzzzzzzzzz", "s9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    verdicts = {r["doc_id"]: [s["verdict"] for s in r["spans"]] for r in secret_scan.scan(docs).collect()}
    assert verdicts[0] == ["copied"] and verdicts[9] == verdicts[11] == ["live"] and verdicts[12] == ["weak"]
    texts = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    assert texts[9] == "token=[SECRET]" and texts[11] == "token=[SECRET] x" and copied in texts[0]


def test_secrets_copied_over_repositories_of_one_owner(spark):
    """Either count decides: many repositories of one owner, or several owners of one repository each."""
    wide, owned = "token=Zk3v9QpL7xWt2BnR", "token=Qm8s1VdH4yKc6TjE"
    rows = [(i, wide, "s1") for i in range(20)] + [(100 + i, owned, "s1") for i in range(19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    verdicts = {r["doc_id"]: [s["verdict"] for s in r["spans"]] for r in secret_scan.scan(docs).collect()}
    assert {tuple(verdicts[i]) for i in range(20)} == {("copied",)} and {tuple(verdicts[100 + i]) for i in range(19)} == {("live",)}
    one = docs.withColumn("doc_id", F.lit(1)).where("source = 's1'")
    assert {s["verdict"] for r in secret_scan.scan(one).collect() for s in r["spans"]} == {"live"}


def test_secrets_in_urls_of_any_length(spark):
    rng = random.Random(6)
    password, user, scheme = ("".join(rng.choices("abcdefghijklmnopqrstuvwxyzQRSTUV", k=k)) for k in (5000, 300, 40))
    texts = [f"see https://bot:{password}@h/x", f"see https://{user}:{password[:20]}@h", f"{scheme}://u:{password[20:40]}@h", "x" * 100_000 + "://" * 50_000]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    cut = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    assert cut == {0: "see https://bot:[SECRET]@h/x", 1: f"see https://{user}:[SECRET]@h", 2: f"{scheme}://u:[SECRET]@h", 3: texts[3]}
    capped = re.compile(r"\b[A-Za-z][A-Za-z0-9+.-]{0,30}://[^\s:/@]{1,200}:([^\s:/@]{3,200})@")
    for _ in range(3000):
        text = "".join(rng.choices(["a", "1", "+", "_", "é", "://", ":", "@", " ", "/", "bcd"], k=14))
        assert list(secret_scan.logins(text)) == [("url", *m.span(), *m.span(1)) for m in capped.finditer(text)]


def test_secrets_of_odd_rows(documents, no_documents):
    assert secret_scan.digest(secret_scan.scan(documents)).count() == documents.count()
    redacted = secret_scan.redact(documents)
    assert redacted.columns == documents.columns and redacted.count() == documents.count()
    assert secret_scan.scan(no_documents).count() == 0 and secret_scan.redact(no_documents).count() == 0


# BPE


def test_bpe_equals_the_public_library(spark, small, documents):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(queries.tokenizer_file(queries.WORD_BPE))
    odd = ["x" * 5000, "thon" * 3000, "don't we'll '", "a\x85b c d\x1cz", "İstanbul ﬁ é Å", "<|startoftext|><|endoftext|>a<|end", "\U0001f600 日本語 한국어", "ΑΣ ΣΑΣ."]
    docs = small("documents").select("doc_id", "text").unionByName(documents.select("doc_id", "text")).unionByName(
        spark.createDataFrame([(20_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    )
    got = Counter((r["doc_id"], r["ids"], r["decoded"]) for r in word_bpe.encode_decode(docs, queries.tokenizer_file(queries.WORD_BPE)).collect())
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"], np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert {(d, bytes(i), t): n for (d, i, t), n in got.items()} == want


def test_bpe_of_every_code_point():
    """Alone, and between letters, where a capital or a mark joins its neighbours."""
    path = queries.tokenizer_file(queries.WORD_BPE)
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        coder = word_bpe.WordBpe(file.read())
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for pattern in ("a{}b", "A {}{} 1"):
        for start in range(0, len(chars), 100_000):
            texts = [pattern.format(c, c) for c in chars[start : start + 100_000]]
            want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
            got = [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)]
            assert [hex(ord(chars[start + i])) for i in range(len(texts)) if got[i] != want[i]] == []


def test_bpe_digest_of_nothing(spark, no_documents):
    assert word_bpe.digest(word_bpe.encode_decode(no_documents, queries.tokenizer_file(queries.WORD_BPE))).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    row = word_bpe.digest(word_bpe.encode_decode(one, queries.tokenizer_file(queries.WORD_BPE))).first()
    assert (row["n_tokens"], row["ids_sha256"]) == (0, hashlib.sha256(b"").hexdigest()) and row["decoded_sha256"] == row["ids_sha256"]


def test_segment_tree_merges_the_leftmost_lowest_pair_first():
    with open(queries.tokenizer_file(queries.WORD_BPE), encoding="utf-8") as file:
        coder = word_bpe.WordBpe(file.read())

    def plainly(ids):
        while True:
            ranked = [(coder.pairs[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in coder.pairs]
            if not ranked:
                return ids
            _, i = min(ranked)
            ids = [*ids[:i], coder.pairs[ids[i], ids[i + 1]][1], *ids[i + 2 :]]

    rng = random.Random(3)
    words = ["".join(rng.choices("aeinrst", k=rng.randint(1, 90))) for _ in range(120)]
    for word, packed in zip(words, coder.encode_words(words)):
        assert np.frombuffer(packed, "<u4").tolist() == plainly(coder.symbols(word.encode()))


# Licences


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def license_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text or ""))


def test_license_base_equals_brute_force(spark, small, documents):
    odd = ["cc by cc by", "CC-BY", "all rights reserved all rights reserved", "general public licenses", "a\x7fb ~cc~by~", "éall rights reserved"]
    docs = small("documents").select("doc_id", "text").unionByName(documents.where("doc_id is not null").select("doc_id", "text").dropDuplicates(["doc_id"]).withColumn("doc_id", F.col("doc_id") + 50_000)).unionByName(
        spark.createDataFrame([(20_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    )
    got = by_id(license_scan.digest(license_scan.scan(docs)))
    for r in docs.collect():
        words = license_words(r["text"])
        places = [(i, label) for label, phrase in license_rules.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        row, starts = got[r["doc_id"]], [i for i, _ in places]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0-or-later"),
        ("under the GNU General Public License version 2 or later", "gpl,gpl-2.0-or-later"),
        ("Creative Commons Attribution-NonCommercial 4.0 International", "cc-by-nc-4.0"),
        ("released under CC BY-SA 3.0", "cc-by,cc-by-sa-3.0"),
        ("the MIT License", "mit"),
        ("BSD 3-Clause license", "bsd-3"),
        ("nothing here", ""),
    ],
)
def test_license_labels(spark, text, labels):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert license_scan.digest(license_scan.scan(docs)).first()["labels"] == labels


def test_license_after_a_hint_or_in_one_word_with_its_version(spark):
    cases = [
        ("Licensed under GPL", "gpl", 0.8),
        ("licensed under the MPL.", "mpl", 0.8),
        ("licensed under CC0", "cc0", 0.95),
        ("Licensed under the WTFPL, see there", "wtfpl", 0.8),
        ("licensed under GPLv2", "gpl-2.0", 0.95),
        ("GPLv3", "gpl-3.0", 0.95),
        ("under the LGPLv2.1 or later", "lgpl-2.1-or-later", 0.95),
        ("LGPLv3", "lgpl-3.0", 0.95),
        ("Licensed under the AGPLv3.0", "agpl-3.0", 0.95),
        ("MPLv2.0", "mpl-2.0", 0.95),
        ("MPL2", "mpl-2.0", 0.95),
        ("licensed under terms of our own", "licensed", 0.4),
    ]
    docs = spark.createDataFrame([(i, text) for i, (text, *_) in enumerate(cases)], "doc_id long, text string")
    got = by_id(license_scan.digest(license_scan.scan(docs)))
    assert [(text, got[i]["labels"], got[i]["score"]) for i, (text, *_) in enumerate(cases)] == cases


def test_license_identifiers_expressions_and_rarer_names(spark):
    cases = [
        ("SPDX-License-Identifier: MIT", "mit", 1.0),
        ("SPDX-License-Identifier: ISC", "isc", 1.0),
        ("// SPDX-License-Identifier: 0BSD\nint main() {}", "0bsd", 1.0),
        ("SPDX-License-Identifier: MS-PL", "ms-pl", 1.0),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3", 1.0),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache-2.0,mit", 1.0),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR Zlib", "gpl-2.0,gpl-classpath,zlib", 1.0),
        ("SPDX-License-Identifier: MIT. A text about boats, tar and tcl", "mit", 1.0),
        ("license = MIT OR Apache-2.0", "apache-2.0,mit", 0.95),
        ("Apache-2.0 or MIT", "apache-2.0,mit", 0.95),
        ("students of MIT or other schools", "", 0.0),
        ("see the licence file for details", "licensed", 0.4),
        ("GNU GPL", "gpl", 0.8),
        ("the GNU GPL v3", "gpl-3.0", 0.95),
        ("Boost License", "bsl", 0.8),
        ("X11 License", "x11", 0.8),
        ("the PostgreSQL Licence", "postgresql", 0.8),
        ("https://www.apache.org/licenses/LICENSE-2.0.txt", "apache-2.0", 0.95),
        ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa", 0.95),
        ("This is free and unencumbered software released into the public domain.", "unlicense", 0.8),
        ("Redistributions of source code must retain the above copyright notice, this list", "bsd", 0.8),
    ]
    docs = spark.createDataFrame([(i, text) for i, (text, *_) in enumerate(cases)], "doc_id long, text string")
    got = by_id(license_scan.digest(license_scan.scan(docs)))
    assert [(text, got[i]["labels"], got[i]["score"]) for i, (text, *_) in enumerate(cases)] == cases


def test_license_detections_equal_plain_search(spark, small):
    """Every rule without a context of its own, by Python's regular expressions over the same words."""
    chosen = [r for r in license_rules.rules() if not r.behind and not r.announced]
    plain = {r.pattern for r in chosen if re.fullmatch("[a-z0-9 ]+", r.pattern)}
    # Names and sentences, and words that go on with a name.
    pieces = sorted(plain | {r.keyword.strip() for r in chosen} | {"2 0", "version 3 0", "or later", "the", "license", "mit license", "and"})
    rng = random.Random(3)
    texts = [" ".join(rng.choices(pieces, k=12)) for _ in range(150)] + [t["text"] or "" for t in small("documents").select("text").limit(40).collect()]
    padded = [" " + " ".join(license_words(t)) + " " for t in texts]
    rows = spark.createDataFrame(list(enumerate(padded)), "row long, words string")
    got = {(r["row"], r["rule"], r["start"], r["stop"]) for r in license_scan.detections(rows, tuple(chosen)).collect()}
    want = set()
    for i, text in enumerate(padded):
        for k, rule in enumerate(chosen):
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", text):
                start = text[: m.start()].count(" ") - 1
                want.add((i, k, start, start + m.group().count(" ") + 1))
                # The keyword test loses no match.
                assert rule.keyword in text, rule
    assert got == want and len({k for _, k, *_ in want}) > 40


def test_license_rules_are_hundreds_and_gated():
    chosen = license_rules.rules()
    assert len(chosen) > 300
    for rule in chosen:
        re.compile(rule.pattern)


def test_suppression_by_containment_and_priority(spark):
    rows = [
        (1, 0, "outer", 2, 0.5, False, 0, 6),
        (1, 1, "inside", 0, 1.0, False, 1, 3),
        (1, 2, "same", 1, 0.9, False, 0, 6),
        (1, 3, "overlap", 3, 0.4, False, 5, 9),
        (1, 4, "apart", 3, 0.4, False, 20, 22),
    ]
    found = spark.createDataFrame(rows, "row long, rule int, label string, priority int, score double, base boolean, start long, stop long")
    assert sorted(r["label"] for r in license_scan.resolved(found).collect()) == ["apart", "same"]


# Base counts of the quality rules


def test_base_counts_equal_brute_force(small):
    texts = [r["text"] for r in small("documents").collect()] + ["", "a b c d e a b c d e", "x\nx\n \n \nx", "é€ #*$%&|<>", "a " * 50]
    for text in texts:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [line for line in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", line)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
        assert ngram_quality.base_counts(text or "") == want
