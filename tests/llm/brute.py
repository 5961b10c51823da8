"""Plain one-process versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SECRETS = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def secrets(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate(SECRETS):
        for match in pattern.finditer(text or ""):
            if len(match[group]) >= least:
                found.append((match.start(), order, kind, match.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def measures(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
    }


def kept(text):
    m = measures(text)
    failed = (
        m["n_words"] < 50
        or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        or 10 * m["n_symbols"] > m["word_chars"]
        or not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"]
        or (m["n_lines"] > 4 and 2 * m["n_dup_lines"] > m["n_lines"])
    )
    return not failed


def line_key(line):
    return line.strip(BLANKS).translate(FOLD)


def dedup_lines(texts, min_docs):
    seen = Counter(key for text in texts for key in {line_key(x) for x in (text or "").split("\n")})
    kept_texts = []
    for text in texts:
        lines = (text or "").split("\n")
        kept_texts.append(
            "\n".join(x for x in lines if not line_key(x) or seen[line_key(x)] < min_docs)
        )
    return kept_texts


def fingerprint(text, words_each=4):
    words = WORD.findall((text or "").translate(FOLD))
    if not words:
        return 0
    n = max(1, len(words) - words_each + 1)
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + words_each]).encode(), seed=42)
        for i in range(n)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def components(values, max_bits=4):
    """Root index of each value, by comparing all pairs."""
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def mix(docs, weights=(5, 2, 1), passes=3, seed=1):
    """Copies of each (doc_id, text, source), by queues and one sorted list."""
    sizes = [len(WORD.findall(text or "")) for _, text, _ in docs]
    sources = sorted({s for *_, s in docs}, key=lambda s: (s is None, (s or "").encode()))
    size_of, weight_of = defaultdict(int), {s: weights[i % 3] for i, s in enumerate(sources)}
    for (_, _, source), size in zip(docs, sizes):
        size_of[source] += size
    total, target = sum(sizes), {}
    while len(target) < len(sources):
        free = [s for s in sources if s not in target]
        level = (total - sum(target.values())) / sum(weight_of[s] for s in free)
        over = [s for s in free if level * weight_of[s] > passes * size_of[s]]
        target |= {s: passes * size_of[s] for s in over} or {s: level * weight_of[s] for s in free}
    sends = []
    for source in sources:
        key = lambda i: (hashlib.md5(f"{seed}:{docs[i][0]}".encode()).hexdigest(), docs[i][0])
        queue = sorted((i for i in range(len(docs)) if docs[i][2] == source), key=key)
        sent = 0
        for _ in range(passes):
            for i in queue:
                sent += sizes[i]
                if sizes[i]:
                    sends.append((sent / target[source], i))
    copies, through = Counter(), 0
    for _, i in sorted(sends):
        through += sizes[i]
        if through > total:
            break
        copies[i] += 1
    return copies, sizes, size_of, target


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=50):
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text), by scoring all documents."""
    counts = [(doc_id, Counter(TERM.findall((text or "").translate(FOLD)))) for doc_id, text in docs]
    counts = [(doc_id, terms) for doc_id, terms in counts if terms]
    n_docs, n_terms = len(counts), sum(terms.total() for _, terms in counts)
    having = Counter(term for _, terms in counts for term in terms)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in having.items()}
    wanted = defaultdict(set)
    for item_id, text in items:
        wanted[item_id] |= set(TERM.findall((text or "").translate(FOLD)))
    found = []
    for item_id, terms in wanted.items():
        scores = []
        for doc_id, own in counts:
            m = 50 + 50 * own.total() * n_docs // n_terms
            score = sum(
                weight[t] * (10**9 * own[t] // (1000 * own[t] + 20 * m)) for t in terms if t in own
            )
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scores)[:k], 1):
            found.append((item_id, rank, doc_id, -score))
    return found


def rebuilt(conversations, every=100, lengths=6):
    """{conv_id: [(role, text)]} of (conv_id, turn, role, text) with the common heads put in."""
    own = defaultdict(list)
    for conv_id, turn, role, text in conversations:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv_id: [said[2:] for said in sorted(turns)] for conv_id, turns in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % lengths for c in own}
    return {c: own.get(c - c % every, [])[: heads[c]] + turns[heads[c] :] for c, turns in own.items()}


def trie(paths):
    """Rows of the prefix trie of {conv_id: turns}, in the columns' order."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv_id, turns in sorted(paths.items()):
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv_id)
        ends[tuple(turns)].append(conv_id)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    return [
        (
            convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children[node],
            leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, convs in members.items()
    ]


def quoted_line(line):
    marks = re.match(r"(?:[ \t]*>)+", line)
    marks = marks[0] if marks else ""
    return marks.count(">"), line[len(marks) :].strip(" \t\r")


def quote_passages(text):
    """(level, said, first, last) of a message, last with the empty quoted lines that follow."""
    lines, found, i = [quoted_line(line) for line in text.split("\n")], [], 0
    while i < len(lines):
        level, first = lines[i][0], i
        while i < len(lines) and lines[i][1] and lines[i][0] == level:
            i += 1
        if i == first:
            i += 1
            continue
        said, last = " ".join(line for _, line in lines[first:i]), i
        while last < len(lines) and lines[last][0] and not lines[last][1]:
            last += 1
        found.append((level, re.sub(r"\s+", " ", said).strip().lower(), first, last - 1))
    return found


def chat(messages):
    """Rows of (conv_id, turn, role, text) with one row a turn, in the columns of the test."""
    convs, rows = defaultdict(dict), []
    for conv_id, turn, _, text in messages:
        convs[conv_id][turn] = text
    for conv_id, texts in convs.items():
        first_said, reply, shown = {}, {}, {}
        for turn in sorted(texts):
            for level, said, *_ in quote_passages(texts[turn]):
                if not level:
                    first_said.setdefault(said, turn)
        for turn, text in texts.items():
            quotes = [p for p in quote_passages(text) if p[0]]
            linked = [p for p in quotes if first_said.get(p[1], turn) < turn]
            gone = {i for *_, first, last in linked for i in range(first, last + 1)}
            content = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
            if linked:
                reply[turn] = -min((level, -first_said[said]) for level, said, *_ in linked)[1]
            shown[turn] = (len({p[:2] for p in quotes}), len({p[:2] for p in linked}), content)

        def thread(turn):
            return thread(reply[turn]) if turn in reply else turn

        order = sorted(texts, key=lambda turn: (thread(turn), turn))
        for position, turn in enumerate(order):
            rows.append((conv_id, position, thread(turn), turn, reply.get(turn), *shown[turn]))
    return rows
