"""WARC archives, URL rules and packing."""

import base64
import gzip
import hashlib
import random
import re
import string
import unicodedata
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millwright.llm.packing import WordTokens, best_fit, pack_documents, sequences, slots, token_pieces
from millwright.llm.url_filter import BLOCK, UrlRule, find_rule, judge_urls, rule_trie, split_url
from millwright.llm.warc import Gap, Record, archived, read_archives, salvage, write_archives
from tests.conftest import SF_DIR
from tests.llm import cases
from tests.llm.cases import clashing, docs, edge_rows, words

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PAGES = "page_id long, url string, html string"

# ---- archives ---------------------------------------------------------------


def record(i, body=None):
    body = (f"<p>page {i}</p>" * 5 if body is None else body).encode()
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\n"
            f"WARC-Payload-Digest: sha256:{hashlib.sha256(body).hexdigest()}\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"


def ids(found):
    return [x.headers["warc-record-id"][10:-1] for x in found if isinstance(x, Record)]


def gaps(found):
    return [(x.start, x.end) for x in found if isinstance(x, Gap)]


def test_sound_archives_are_read_whole():
    records = [record(i) for i in range(5)]
    for data in (b"".join(records), b"".join(map(gzip.compress, records)), gzip.compress(b"".join(records))):
        found = list(salvage(data))
        assert ids(found) == list("01234") and gaps(found) == []
    assert list(salvage(b"")) == [] and ids(salvage(record(1, ""))) == ["1"]


def test_a_damaged_record_is_a_gap_and_later_ones_are_found():
    records = [record(i) for i in range(5)]
    starts = np.cumsum([0, *map(len, records)])
    for hurt in (
        records[2].replace(b"page 2", b"PAGE 2", 1),  # digest
        records[2].replace(b"Content-Length: ", b"Content-Length: 9"),  # length
        records[2].replace(b"WARC/1.1", b"WXRC/1.1"),  # version line
        records[2][:-30],  # end
        b"\r\n\r\n" + b"noise" * 10,
    ):
        data = b"".join([*records[:2], hurt, *records[3:]])
        found = list(salvage(data))
        assert ids(found) == ["0", "1", "3", "4"]
        assert gaps(found) == [(starts[2], starts[2] + len(hurt))]


def test_a_damaged_member_is_a_gap_and_what_came_before_the_damage_is_kept():
    pick = random.Random(1)
    bodies = ["".join(pick.choices("abcdefgh <>/", k=60_000)) for _ in range(6)]
    members = [gzip.compress(record(i, b)) for i, b in enumerate(bodies)]
    hurt = bytearray(members[2])
    hurt[len(hurt) // 2] ^= 0xFF
    data = b"".join([*members[:2], bytes(hurt), *members[3:]])
    found = list(salvage(data))
    start = len(members[0]) + len(members[1])
    assert ids(found) == ["0", "1", "3", "4", "5"] and gaps(found) == [(start, start + len(hurt))]
    cut = data[: len(data) - len(members[5]) // 2]
    assert ids(salvage(cut)) == ["0", "1", "3", "4"]
    one = gzip.compress(b"".join(record(i, b) for i, b in enumerate(bodies)))
    found = list(salvage(one[: len(one) // 2]))
    assert ids(found) == ["0", "1"] or ids(found) == ["0", "1", "2"]
    assert gaps(found)


def test_fake_version_lines_inside_a_sound_record_are_payload():
    body = "x\r\n" + record(7).decode() + "y"
    assert ids(salvage(record(1, body) + record(2))) == ["1", "2"]


def pages(spark):
    long = "<p>" + "long " * 50_000 + "</p>"
    same = "<html>" + "same " * 40 + "</html>"
    rows = [
        (5, "http://a/", same), (3, None, same), (9, "http://b\r\nX: y/ z", same), (1, "u", "tiny"), (2, "u", "tiny"),
        (4, "u", None), (6, "u", ""), (7, "u", long), (8, "u", long), (8, "u", long), (None, "u", same),
        (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5), (11, "u", "é" * 60), (3, "u", same),
    ]
    return spark.createDataFrame(rows, PAGES)


def expected_pages(rows):
    first = {}
    for r in rows:
        if r.page_id is not None:
            body = (r.html or "").encode()
            first[body] = min(first.get(body, r.page_id), r.page_id)
    found = []
    for r in rows:
        body = (r.html or "").encode()
        again = len(body) >= 100 and body in first and r.page_id != first[body]
        found.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                      first[body] if again else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_pages_come_back(spark, folder, compression):
    table = pages(spark)
    found = archived(table, f"{folder}/warc", compression=compression, records_per_file=4)
    assert cases.rows_of(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == \
        expected_pages(table.collect())
    read = read_archives(spark, f"{folder}/warc")
    assert read.where("kind = 'gap'").count() == 0 and read.select("path").distinct().count() > 2
    bodies = {r.record_id: bytes(r.payload).decode() for r in read.where("warc_type = 'response'").collect()}
    assert bodies["<urn:page:11>"] == "é" * 60 and bodies["<urn:page:4>"] == ""


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_pages_with_long_urls_come_back(spark, folder, compression):
    same = "<html>" + "same " * 40 + "</html>"
    rows = [(1, "data:" + "x" * 100_000, same), (2, "http://a/" + "\t." * 50_000, same), (3, "u", same)]
    table = spark.createDataFrame(rows, PAGES).coalesce(1)
    found = archived(table, f"{folder}/long", compression=compression)
    assert cases.rows_of(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == \
        expected_pages(table.collect())
    read = {r.record_id: r for r in read_archives(spark, f"{folder}/long").collect()}
    assert {r.kind for r in read.values()} == {"record"}
    assert [len(read[f"<urn:page:{i}>"].target_uri) for i in (1, 2, 3)] == [100_005, 9 + 4 * 50_000, 1]


def test_long_headers_are_found_behind_damage_and_many_version_lines_cost_no_more():
    long = record(2).replace(b"WARC-Type", b"WARC-Target-URI: " + b"u" * 200_000 + b"\r\nWARC-Type", 1)
    for hurt in (b"WARC/1.1\r\n" * 100_000, b"WARC/1.1\r\n" + b"a: WARC/1.1\r\n" * 100_000 + b"\r\n"):
        for data in (record(1) + hurt + long, gzip.compress(record(1) + hurt + long)):
            found = list(salvage(data))
            assert ids(found) == ["1", "2"]
            assert gaps(found) == [(len(record(1)), len(record(1)) + len(hurt))]
    member = gzip.compress(record(3), mtime=0)
    assert ids(salvage(b"WARC/1.1\r\na: " + member + b"\r\nno colon\r\n" + long)) == ["3", "2"]


def test_damage_to_an_archive_as_written_costs_one_record(spark, folder):
    pick = random.Random(2)
    rows = [(i, f"http://a/{i}", "".join(pick.choices("abcdefgh <>/", k=3_000)) + "\u00e9") for i in range(30)]
    write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), f"{folder}/hurt")
    file, = Path(f"{folder}/hurt").glob("part-*")
    data = bytearray(file.read_bytes())
    assert gzip.decompress(bytes(data)).count(b"WARC/1.1\r\n") == 30
    whole = ids(salvage(bytes(data)))
    assert sorted(map(int, whole)) == list(range(30)) and gaps(salvage(bytes(data))) == []
    data[len(data) // 4] ^= 0xFF
    left = ids(salvage(bytes(data)))
    assert len(left) == 29 and left[-1] == whole[-1] and len(gaps(salvage(bytes(data)))) == 1


def test_pages_come_back_from_members(spark, folder):
    table = pages(spark)
    found = archived(table, f"{folder}/members", records_per_file=4)
    assert cases.rows_of(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == \
        expected_pages(table.collect())
    assert read_archives(spark, f"{folder}/members").where("kind = 'gap'").count() == 0


def test_no_pages(spark, folder):
    table = spark.createDataFrame([], PAGES)
    assert archived(table, f"{folder}/none").collect() == []
    write_archives(clashing(pages(spark).limit(1)), f"{folder}/extra")
    assert read_archives(spark, f"{folder}/extra").count() == 1


def test_gaps_are_reported_with_their_bytes(spark, folder):
    records = [record(i) for i in range(3)]
    path = Path(folder) / "in"
    path.mkdir()
    (path / "x.warc").write_bytes(records[0] + b"\0" * 17 + records[2])
    rows = read_archives(spark, str(path)).collect()
    gap = next(r for r in rows if r.kind == "gap")
    assert (gap.start_offset, gap.end_offset, gap.reason) == (len(records[0]), len(records[0]) + 17, "no version line")
    assert sum(r.kind == "record" for r in rows) == 2


# ---- urls -------------------------------------------------------------------


def test_urls(spark):
    cases_ = {
        "https://www.Example.COM/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://blog.example.com/en/": ("blog.example.com", "/en/", "example.com/en/", "block"),
        "http://example.com/en": ("example.com", "/en", "com/", "allow"),
        "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
        "http://a.net/es/": ("a.net", "/es/", "net/es/", "block"),
        "http://a.net/de/": ("a.net", "/de/", None, "allow"),
        "http://com": ("com", "", None, "allow"),
        "http://x.com?u=/en/": ("x.com", "", None, "allow"),
        "ftp://É.net/fr/a://b": ("É.net", "/fr/a://b", "net/fr/", "block"),
        "no scheme/en/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://": ("", "", None, "allow"), "http:///en/": ("", "/en/", None, "allow"),
        "http://net" + "/es" * 5_000: ("net", "/es" * 5_000, "net/es/", "block"),
    }
    rows = [(i, url) for i, url in enumerate(cases_)] + [(None, "http://a.net/es/"), (4, "http://a.net/es/")]
    table = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "1 as rule")
    found = judge_urls(table).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: tuple(r)[1:] for r in found if r.page_id is not None}
    assert [by_id[i] for i in range(len(cases_))] == list(cases_.values())
    assert judge_urls(table.limit(0)).collect() == []


def test_longest_match_and_ties():
    rules = (UrlRule("allow", "a.b", "/x"), UrlRule("block", "a.b", "/x/y"), UrlRule("block", "b", "/"),
             UrlRule("allow", "c", "/"), UrlRule("block", "c", "/"), UrlRule("allow", "c", "/"))
    trie = rule_trie(rules)
    assert find_rule(trie, "z.a.b", "/xyz") == ("a.b/x", "allow")
    assert find_rule(trie, "a.b", "/x/yes") == ("a.b/x/y", "block")
    assert find_rule(trie, "a.b", "/q") == ("b/", "block")
    assert find_rule(trie, "c", "/") == ("c/", BLOCK)
    assert find_rule(trie, "d", "/") is None
    with pytest.raises(ValueError):
        rule_trie((UrlRule("maybe", "a"),))
    assert split_url("x://H/p#a?b") == ("h", "/p")


# ---- packing ----------------------------------------------------------------


def check_places(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_have_the_tokenizers_ids(spark):
    texts = [t for _, t in cases.documents(spark, SF_DIR)[:60]]
    texts += ["", "<|endoftext|> <|ENDOFTEXT|> a", "I'LL don't...  x\u00a0y\u3000z ΣΑΣ İ e\u0301 A\u0301 !?", words(3_000, 1), "a b\x1cc\x85d"]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    found = {}
    for r in token_pieces(docs(spark, enumerate(texts)), VOCABULARY, 512).collect():
        found.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(found[i], key=lambda r: r.piece)
        assert [r.start for r in parts] == list(range(0, len(ids), 512))
        for r in parts:
            own = ids[r.start : r.start + 512]
            assert (r.length, r.ids_crc32, bytes(r.ids)) == (len(own), zlib.crc32(own.tobytes()), own.tobytes())


def test_letters_with_marks_have_the_tokenizers_ids():
    """All of A-Z and a-z before every mark that composes with a letter, alone, two in a row and between others."""
    marks = sorted({unicodedata.normalize("NFD", chr(c))[1:] for c in range(0xC0, 0x1F00)
                    if unicodedata.normalize("NFD", chr(c))[0] in string.ascii_letters} - {""})
    pairs = [letter + mark for letter in string.ascii_letters for mark in marks]
    texts = ["H\u0331a", "J\u030ca", "T\u0308", "W\u030a", "Y\u030a", "H\u0323\u0331", "J\u0323\u030c", "\u00c9H\u0331A. H\u0331a,"]
    texts += pairs + [f"Ab{p}Cd. \u00c9{p}, x{p}" for p in pairs] + [" ".join(pairs), " ".join(p + "a." for p in pairs)]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for text, ids in zip(texts, WordTokens(VOCABULARY).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_packing_of_the_documents(spark):
    rows = cases.documents(spark, SF_DIR)
    table = clashing(docs(spark, rows)).repartition(5)
    placed = pack_documents(table, VOCABULARY, with_ids=True)
    found = placed.collect()
    n = check_places(found, 2048)
    total = sum(r.length for r in found)
    assert n <= -(-total // 2048) + 1
    assert {r.doc_id for r in found} == {d for d, _ in rows}
    whole = {r.sequence_id: bytes(r.ids) for r in sequences(placed).collect()}
    for r in found:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_packing_edges(spark):
    found = pack_documents(docs(spark, edge_rows()), VOCABULARY).collect()
    check_places(found, 2048)
    assert [r.length for r in found if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert sum(r.doc_id == 8 for r in found) == 2 * sum(r.doc_id == 7 for r in found)  # repeated rows are packed each
    assert pack_documents(docs(spark, []), VOCABULARY).collect() == []


def test_best_fit_is_that_of_single_pieces():
    """The plan on counts uses as many sequences as best-fit decreasing over the pieces."""
    pick = random.Random(3)
    for capacity in (10, 64, 2048):
        lengths = sorted((min(capacity, 1 + int(pick.expovariate(5 / capacity))) for _ in range(3_000)), reverse=True)
        free = []
        for length in lengths:
            fits = [f for f in free if f >= length]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - length)
            else:
                free.append(capacity - length)
        histogram = {x: lengths.count(x) for x in set(lengths)}
        plan = best_fit(histogram, capacity)
        assert sum(b.count for b in plan) == len(free)
        held = {}
        for bins in plan:
            assert bins.free == capacity - sum(length * many for length, many, _ in bins.runs)
            for length, many, _ in bins.runs:
                held[length] = held.get(length, 0) + many * bins.count
        assert held == histogram
        assert len(slots(plan)) < 8 * len(histogram)
    assert best_fit({}, 8) == [] and len(slots([])) == 0
    with pytest.raises(ValueError):
        best_fit({9: 1}, 8)


def test_a_length_that_most_pieces_have(spark):
    rows = [(i, "same text here") for i in range(9_000)] + [(10_000 + i, words(1 + i % 5, i)) for i in range(300)]
    found = pack_documents(docs(spark, rows), VOCABULARY, capacity=64).collect()
    check_places(found, 64)
    assert len(found) == len(rows)


def test_joined_words_have_the_ids_of_each_alone():
    """Every letter below U+0250, in either case and beside others, and texts that need a path of their own."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha()]
    texts = ["", " ", " ".join(letters), " ".join(f"a{x}B" for x in letters), " ".join(x + y for x, y in zip(letters, letters[7:], strict=False))]
    texts += ["\u0130x \u0130", "H\u0331a J\u030c", "<|endoftext|> a", "\x0bx\x0c y\r\nz\t", "a\xa0b \u3000 c", "one, two. three.\n" * 300, *texts[2:]]
    coder = WordTokens(VOCABULARY, capacity=100)
    for _ in range(3):
        for text, ids in zip(texts, coder.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert coder.encode([]) == [] and coder.encode(["<|"])[0] and coder.encode([""]) == [b""]


# ---- archives that others wrote, or that are damaged ----------------------------


def test_digests_of_other_writers_are_checked():
    body = b"<p>some page</p>"
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:0>\r\nWARC-Payload-Digest: %s\r\nContent-Length: %d\r\n\r\n"
    sha1, sha256 = hashlib.sha1(body), hashlib.sha256(body)
    sound = [f"sha1:{base64.b32encode(sha1.digest()).decode()}", f"SHA1:{sha1.hexdigest()}", f"sha256:{sha256.hexdigest().upper()}",
             f"sha256:{base64.b32encode(sha256.digest()).decode().rstrip('=')}", f"md5:{hashlib.md5(body).hexdigest()}", "blake9:abc", "none"]
    for stated in sound:
        data = head % (stated.encode(), len(body)) + body + b"\r\n\r\n"
        assert ids(salvage(data)) == ["0"], stated
        changed = data.replace(b"some page", b"same page")
        assert bool(gaps(salvage(changed))) == (stated not in sound[-2:]), stated
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\n<p>so"
    chunked = (head % (sound[0].encode(), len(http))).replace(b"Content-Length", b"Content-Type: application/http\r\nContent-Length")
    assert ids(salvage(chunked + http + b"\r\n\r\n")) == ["0"]


def test_folded_lines_and_absurd_lengths():
    folded = record(1).replace(b"WARC-Type: resource\r\n", b"WARC-Type: resource\r\nWARC-Target-URI: http://a/\r\n  b\r\n\tc\r\n")
    (found,) = salvage(folded)
    assert found.headers["warc-target-uri"] == "http://a/ b c" and ids([found]) == ["1"]
    absurd = re.sub(rb"Content-Length: \d+", b"Content-Length: " + b"9" * 5_000, record(2))
    assert ids(salvage(record(1) + absurd + record(3))) == ["1", "3"]


@pytest.mark.parametrize("packed", [False, True])
def test_damage_costs_only_the_records_that_it_touches(packed):
    """Bytes cut out, flipped and put in at random places; records behind them are found."""
    pick = random.Random(packed)
    records = [record(i, "".join(pick.choice("abc <>\r\n") for _ in range(pick.randrange(400)))) for i in range(12)]
    parts = [gzip.compress(r) if packed else r for r in records]
    starts = np.cumsum([0, *map(len, parts)])
    for _ in range(400):
        data, touched = bytearray(b"".join(parts)), set()
        at = pick.randrange(len(data))
        many = pick.randrange(1, 40)
        first, last = np.searchsorted(starts, [at, min(at + many, len(data) - 1)], side="right") - 1
        kind = pick.choice(["cut", "flip", "put"])
        if kind == "cut":
            del data[at : at + many]
            touched = set(range(first, last + 1))
        elif kind == "flip":
            data[at] ^= 1 << pick.randrange(8)
            touched = {first}
        else:
            data[at:at] = pick.randbytes(many)
            touched = {first} - ({first} if at == starts[first] else set())
        found = ids(salvage(bytes(data)))
        assert {str(i) for i in range(12) if i not in touched} <= set(found), (kind, at, many)


def test_lost_stretches_raise_and_files_are_bounded_by_bytes(spark, folder, monkeypatch):
    rows = spark.createDataFrame([(i, "http://a/", f"<p>{i}</p>" + "x" * 3_000) for i in range(40)], PAGES).coalesce(1)
    monkeypatch.setattr("millwright.llm.warc.FILE_BYTES", 10_000)
    assert archived(rows, f"{folder}/a", compression="none").count() == 40
    files = sorted(Path(f"{folder}/a").glob("part-*"))
    assert len(files) >= 13 and max(f.stat().st_size for f in files) < 14_000
    data = files[0].read_bytes()
    monkeypatch.setattr("millwright.llm.warc.write_archives", lambda *_, **__: None)
    files[0].write_bytes(data.replace(b"WARC/1.1", b"WARC/9.9", 1))
    Path(f"{folder}/a/.{files[0].name}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="1 stretches"):
        archived(rows, f"{folder}/a")
