"""The operators' results by plain loops over a few texts, each written apart from the operator it checks."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import xxhash

TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")


def oracle(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def rows_of(names, records):
    """Rows as text, columns by name, in order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in records)


def library_counts(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [len(model.encode(t or "", add_special_tokens=False).ids) for t in texts]


def library_ids(texts):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [coder.encode_ordinary(t or "") for t in texts]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, max_bits=2):
    """Least id reachable of each id, from {id: fingerprint}, over all pairs."""
    least = dict.fromkeys(prints)
    for i in sorted(prints):
        if least[i] is None:
            least[i], todo = i, [i]
            while todo:
                a = todo.pop()
                for b in prints:
                    if least[b] is None and (prints[a] ^ prints[b]).bit_count() <= max_bits:
                        least[b] = i
                        todo.append(b)
    return least


def decontamination(docs, items):
    """(doc_id, n_words, n_hit, n_items, digest) from (id, text) pairs."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        w = word.findall(lowered(text))
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    found = []
    for doc, text in docs:
        w, hit, held = word.findall(lowered(text)), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    held |= windows[tuple(w[i : i + size])]
        found.append((doc, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()))
    return found


def url_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = lowered(re.split(r"[/?#]", rest)[0])
        path = re.split(r"[?#]", rest[len(host) :])[0]
    best = None
    for rule, action in rules:
        rule_host, slash, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path) and host:
            best = max(best or (0, "", ""), (len(rule), rule, action))
    return host, path, best and best[1], best[2] if best else "allow"


def base_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(repeated),
            len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def base_secrets(text):
    """(start, order, kind, end) of the base spans."""
    kinds = [
        ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 1, 8),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32)]
    return sorted((m.start(), n, kind, m.end()) for n, (kind, pattern, group, least) in enumerate(kinds)
                  for m in pattern.finditer(text or "") if len(m[group]) >= least)


def held_out(doc_id, parts, part):
    return zlib.crc32(str(doc_id).encode()) % parts == part
