"""Conversation structure repair: generalised LR parsing with weighted edits.

A conversation's roles should read ``(s?(ua)+)?``: nothing, or a system message
at most, then user and assistant in turn. The role grammar is compiled to an
SLR table (cells may hold several actions). A row can be kept, given another
role, deleted, or preceded by inserted messages; each edit has a cost.

* *Graph-structured stack.* A stack node is an LR state on another node and is
  made once, so stacks share their lower parts and equal stacks are one node.
  All stacks that some edits of the rows so far lead to are followed at once.
* *Merging.* Equal stack tops keep the edits of minimum (cost, audit), where
  the audit is the string of the edits' initials. That is exact: two audits
  that consumed the same rows, end with a row's edit and reach the same top at
  the same cost are never prefixes of one another, so what follows them does
  not change their order.
* *Blocks.* Rows count for the parser as symbols (role initial and fault). A
  block of symbols maps each stack top before it to the tops after it; the
  maps are remembered, for most conversations look alike, and are composed for
  longer conversations, so time is linear in the rows.

Conversations are dealt by id and read in order of ``turn`` (NULL first; rows
of one turn by role, then text). A task holds one block of rows, one hash state
for each stack top, 16 bytes a distinct row and a byte a row (the audit) of the
conversation at hand, never its texts: the digest of a conversation is one
SHA-256 in order, so one task must see its rows, and it sees them as a stream.
Only ``messages=True`` holds the texts of one conversation.

Faults, the first of a row counts: *blank* (nothing but white space),
*duplicate* (role and text stand in an earlier row), *truncated* (the last
character that is not white space is none of ``.!?``). Blank rows and
duplicates must be deleted; truncated rows cost ``TRUNCATED`` more if kept.

Cases: NULL roles and texts are one space (so a NULL text is blank); a NULL id
is a conversation of its own; NULL turns come first and do not count for gaps;
equal rows are duplicates; roles with another initial cannot be kept; an empty
table gives no rows; other columns are not read; a conversation of which no row
is left has an empty result row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The contract's costs, white space and ends of sentences.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
ROLE_OF = {"u": "user", "a": "assistant"}

#: The role grammar; left recursion keeps stacks short.
GRAMMAR = (("C", ()), ("C", ("T",)), ("C", ("s", "T")), ("T", ("u", "a")), ("T", ("T", "u", "a")))
END = "$"
#: Rows that the parser takes at a time.
BLOCK = 256


class Table:
    """SLR(1) actions of a grammar whose first rule's left side is the start symbol."""

    def __init__(self, rules: tuple[tuple[str, tuple[str, ...]], ...]):
        self.rules = (("", (rules[0][0],)), *rules)
        self.heads = {left for left, _ in self.rules}
        self._follow = self._follows()
        self.states = [self._closure({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for i, state in enumerate(self.states):  # grows while it is read
            for symbol in sorted({right[at] for r, at in state if at < len(right := self.rules[r][1])}):
                after = self._closure({(r, at + 1) for r, at in state if self.rules[r][1][at : at + 1] == (symbol,)})
                if after not in self.states:
                    self.states.append(after)
                self.goto[i, symbol] = self.states.index(after)

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        items = set(items)
        while True:
            wanted = {right[at] for r, at in items if at < len(right := self.rules[r][1])}
            more = {(r, 0) for r, (left, _) in enumerate(self.rules) if left in wanted} - items
            if not more:
                return frozenset(items)
            items |= more

    def _follows(self) -> dict[str, set[str]]:
        first: dict[str, set[str]] = {h: set() for h in self.heads}  # "" stands for nothing
        follow: dict[str, set[str]] = {h: set() for h in self.heads}
        follow[""].add(END)

        def starts(symbols: tuple[str, ...]) -> set[str]:
            found: set[str] = set()
            for s in symbols:
                these = first.get(s, {s})
                found |= these - {""}
                if "" not in these:
                    return found
            return found | {""}

        while True:
            size = sum(map(len, (*first.values(), *follow.values())))
            for left, right in self.rules:
                first[left] |= starts(right)
                for i, s in enumerate(right):
                    if s in self.heads:
                        rest = starts(right[i + 1 :])
                        follow[s] |= (rest - {""}) | (follow[left] if "" in rest else set())
            if sum(map(len, (*first.values(), *follow.values()))) == size:
                return follow

    def reductions(self, state: int, ahead: str) -> list[int]:
        return [r for r, at in sorted(self.states[state]) if r and at == len(self.rules[r][1]) and ahead in self._follow[self.rules[r][0]]]


class Node:
    """A stack: an LR state on another stack."""

    __slots__ = ("state", "below", "_on", "_moves")

    def __init__(self, state: int, below: Node | None = None):
        self.state, self.below = state, below
        self._on: dict[int, Node] = {}
        self._moves: dict[str, list[Node]] = {}

    def push(self, state: int) -> Node:
        if state not in self._on:
            self._on[state] = Node(state, self)
        return self._on[state]


class Parser:
    """All stacks of a grammar at once, with the cheapest edits for each."""

    def __init__(self, rules=GRAMMAR):
        self.table, self.root = Table(rules), Node(0)

    def _reduced(self, node: Node, ahead: str) -> list[Node]:
        """The node and all that its reductions before ``ahead`` lead to."""
        found = [node]
        for top in found:
            for r in self.table.reductions(top.state, ahead):
                left, right = self.table.rules[r]
                base = top
                for _ in right:
                    base = base.below
                after = base.push(self.table.goto[base.state, left])
                if after not in found:
                    found.append(after)
        return found

    def shift(self, node: Node, role: str) -> list[Node]:
        """The stacks after ``role`` (none where it cannot follow)."""
        moves = node._moves.get(role)
        if moves is None:
            goto = self.table.goto
            moves = node._moves[role] = [n.push(goto[n.state, role]) for n in self._reduced(node, role) if (n.state, role) in goto]
        return moves

    def accepts(self, node: Node) -> bool:
        done = self.table.goto[0, self.table.rules[0][1][0]]
        return any(n.state == done and n.below is self.root for n in self._reduced(node, END))

    def _insert(self, tops: dict[Node, tuple[int, str]]) -> dict[Node, tuple[int, str]]:
        """The tops, and those that inserted messages lead to."""
        best = dict(tops)
        queue = list(tops)
        while queue:
            node = queue.pop()
            cost, audit = best[node]
            for role in ROLE_OF:
                for after in self.shift(node, role):
                    if (cost + INSERT, audit + "I") < best.get(after, (cost + INSERT + 1, "")):
                        best[after] = (cost + INSERT, audit + "I")
                        queue.append(after)
        return best

    def step(self, tops: dict[Node, tuple[int, str]], symbol: str) -> dict[Node, tuple[int, str]]:
        """The tops after one row. Symbols: ``-`` must go; role initials, in upper case if truncated."""
        # inserting after a deletion reads smaller than before it, so deletion needs no inserted messages
        out = {node: (cost + DELETE, audit + "D") for node, (cost, audit) in tops.items()}
        if symbol == "-":
            return out
        extra = TRUNCATED if symbol.isupper() else 0
        for node, (cost, audit) in self._insert(tops).items():
            for role in ("s", *ROLE_OF):
                edits = [(cost + extra, audit + "K")] if role == symbol.lower() else []
                if role in ROLE_OF:
                    edits.append((cost + extra + REROLE, audit + "R"))
                for after in self.shift(node, role) if edits else ():
                    best = min(edits)
                    if after not in out or best < out[after]:
                        out[after] = best
        return out

    @lru_cache(maxsize=1 << 14)  # noqa: B019 - one parser a process
    def block(self, node: Node, symbols: str) -> dict[Node, tuple[int, str]]:
        tops = {node: (0, "")}
        for symbol in symbols:
            tops = self.step(tops, symbol)
        return tops

    @lru_cache(maxsize=1 << 10)  # noqa: B019
    def ending(self, node: Node) -> tuple[int, str] | None:
        """The cheapest messages to insert at the end."""
        return min((way for after, way in self._insert({node: (0, "")}).items() if self.accepts(after)), default=None)

    def role_for(self, node: Node, edit: str, role: str) -> tuple[str, Node]:
        """The role that a kept, rerolled or inserted message has, and the stack after it."""
        if edit == "K":
            return role, self.shift(node, role[:1])[0]
        letter = next(r for r in ROLE_OF if self.shift(node, r))
        return ROLE_OF[letter], self.shift(node, letter)[0]

    def edited(self, node: Node, audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
        """The messages that the edits make of the rows."""
        rows = iter(rows)
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(rows)
            if edit != "D":
                role, node = self.role_for(node, edit, role)
                yield role, text


_PARSER: list[Parser] = []


def parser() -> Parser:
    """This process's parser."""
    if not _PARSER:
        _PARSER.append(Parser())
    return _PARSER[0]


class Top:
    """A stack top between blocks: cost, place in the order of audits, the audit so far and what hangs on it."""

    __slots__ = ("cost", "rank", "audit", "hash", "any", "rows")

    def __init__(self, cost: int, rank: int, audit: tuple, sha, any_: bool, rows: list | None):
        self.cost, self.rank, self.audit, self.hash, self.any, self.rows = cost, rank, audit, sha, any_, rows

    def extended(self, p: Parser, node: Node, way: tuple[int, str], rank: int, rows: list[tuple[str, str]]) -> Top:
        sha, some = self.hash.copy(), self.any
        kept = None if self.rows is None else list(self.rows)
        for role, text in p.edited(node, way[1], rows):
            sha.update((("\n" if some else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            some = True
            if kept is not None:
                kept.append((role, text))
        return Top(self.cost + way[0], rank, (self.audit, way[1]), sha, some, kept)


class Conversation:
    """One conversation, fed row by row."""

    def __init__(self, messages: bool):
        self.parser, self.messages = parser(), messages
        self.tops = {self.parser.root: Top(0, 0, (), hashlib.sha256(), False, [] if messages else None)}
        self.rows: list[tuple[str, str]] = []
        self.symbols: list[str] = []
        self.seen: set[bytes] = set()
        self.counts = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = self.turn = None
        self.turns, self.last = 0, None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        """``fault``: "" , "blank" or "truncated"."""
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if fault != "blank" and key in self.seen:
            fault = "duplicate"
        self.seen.add(key)
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last = initial
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
                self.turn = turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        letter = initial if initial in ("s", "u", "a") else "x"
        self.symbols.append("-" if fault in ("blank", "duplicate") else letter.upper() if fault == "truncated" else letter)
        self.rows.append((role, text))
        if len(self.rows) == BLOCK:
            self._advance()

    def _advance(self) -> None:
        symbols, p = "".join(self.symbols), self.parser
        best: dict[Node, tuple] = {}
        for node, top in self.tops.items():
            for after, (cost, audit) in p.block(node, symbols).items():
                way = (top.cost + cost, top.rank, audit, node)
                if after not in best or way[:3] < best[after][:3]:
                    best[after] = way
        order = {after: i for i, after in enumerate(sorted(best, key=lambda n: best[n][1:3]))}
        self.tops = {after: self.tops[node].extended(p, node, (cost - self.tops[node].cost, audit), order[after], self.rows) for after, (cost, _, audit, node) in best.items()}
        self.rows, self.symbols = [], []

    def close(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha, messages)"""
        p, symbols = self.parser, "".join(self.symbols)
        best = None
        for node, top in self.tops.items():
            for after, (cost, audit) in p.block(node, symbols).items():
                end = p.ending(after)
                if end is not None:
                    way = (top.cost + cost + end[0], top.rank, audit + end[1], node)
                    if best is None or way[:3] < best[:3]:
                        best = way
        cost, _, audit, node = best
        last = self.tops[node].extended(p, node, (cost - self.tops[node].cost, audit), 0, self.rows)
        parts, link = [], last.audit
        while link:
            link, part = link
            parts.append(part)
        if self.turns:
            self.counts["gaps"] = self.high - self.low + 1 - self.turns
        return (*self.counts.values(), last.cost, "".join(reversed(parts)), last.hash.hexdigest(), last.rows)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _repair(messages: bool):
    """Rows (conv_id, turn, role, text, fault, copies) in order to one row a conversation."""

    def rows(kind: pa.DataType, found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((kind, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()))]
        names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
        if messages:
            columns.append(pa.array([[{"role": r, "text": t} for r, t in f[-1]] for f in found], _MESSAGES))
            names.append("messages")
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, kind, found = None, None, None, []
        for batch in batches:
            kind = batch.column(0).type
            for conv, turn, role, text, fault, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or conv != key:
                    if held is not None:
                        found.append((key, *held.close()))
                    held, key = Conversation(messages), conv
                for _ in range(copies):
                    held.add(turn, role, text, fault)
            if len(found) > 1000:
                yield rows(kind, found)
                found = []
        if held is not None:
            found.append((key, *held.close()))
            yield rows(kind, found)

    return run


def _last(text: Column) -> Column:
    """The last character that is not white space (empty if there is none)."""
    return F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None, messages: bool = False) -> DataFrame:
    """One row a conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256[, messages]``.

    ``repaired_sha256`` is of the repaired ``role:text`` lines; ``messages``
    has them as structs. ``copies_col`` says how often a row stands (0: its
    conversation is still returned).
    """
    blank = F.lit(" ")
    text, role = F.coalesce(F.col(text_col).cast("string"), blank), F.coalesce(F.col(role_col).cast("string"), blank)
    fault = F.when(_last(text) == "", "blank").when(~_last(text).isin(*ENDS), "truncated").otherwise("")
    copies = F.col(copies_col).cast("int") if copies_col else F.lit(1)
    ordered = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), fault.alias("fault"), copies.alias("copies"))
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    ddl = f"conv_id {rows.schema[conv_col].dataType.simpleString()}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string"
    return ordered.mapInArrow(_repair(messages), ddl + (", messages array<struct<role: string, text: string>>" if messages else ""))


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with faults planted by a checksum of ``conv_id:turn``: ``conv_id, turn, role, text, copies``.

    Of 20 remainders 0 drops a row (``copies`` 0), 1 empties its text, 2 takes
    the ends of its sentences away, 3 has it twice, 4 makes it the user's.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    code, text, role = F.col("code"), F.coalesce(F.col(text_col).cast("string"), blank), F.coalesce(F.col(role_col).cast("string"), blank)
    coded = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("code"))
    text = F.when(code.isin(0, 1), "").when(code == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return coded.select("conv_id", "turn", F.when(code == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))


def _oracle() -> str:
    """The same by dynamic programming over four states (nothing, s, u, a) in a recursive query."""
    add = lambda way, cost, letter, role=None, text="''": (
        f"{{'c': {way}.c + {cost}, 'a': {way}.a || '{letter}', 'o': {way}.o" + ("" if role is None else f" || CASE WHEN {way}.o = '' THEN '' ELSE chr(10) END || {role} || ':' || {text}") + "}"
    )
    least = lambda *ways: f"list_sort([{', '.join(ways)}])[1]"
    insert = lambda way, role: add(way, INSERT, "I", f"'{role}'")
    none = "{'c': CAST(1000000000 AS BIGINT), 'a': '', 'o': ''}"
    extra = f"CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END"

    def after(state: str, sources: tuple[str, ...], name: str | None) -> str:
        kept = [add(x, extra, "K", "role", "text") for x in sources]
        moved = [add(x, f"{REROLE} + {extra}", "R", f"'{name}'", "text") for x in sources] if name else []
        gone = add(state, DELETE, "D")
        same = f"initial = '{state}'"
        also = least(gone, *moved) if moved else gone
        return f"CASE WHEN fault IN ('blank', 'duplicate') THEN {gone} WHEN {same} THEN {least(gone, *kept, *moved)} ELSE {also} END AS {state}"

    return rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
coded AS (
  SELECT *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ord(k[i]) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END), xor(c, b)),
    CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 20 AS code
  FROM src),
dam AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded WHERE code <> 0),
ord AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER w AS rn, lag(left(role, 1)) OVER w AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS tail
  FROM dam WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
marked AS (
  SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM ord),
ids AS (SELECT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS cid FROM (SELECT DISTINCT conv_id FROM conversations)),
numbered AS (SELECT ids.cid, m.* FROM marked m JOIN ids ON m.conv_id IS NOT DISTINCT FROM ids.conv_id),
dp AS (
  SELECT cid, CAST(0 AS BIGINT) AS rn, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS e, {none} AS s, {none} AS u, {none} AS a FROM ids
  UNION ALL
  SELECT cid, rn, {add('e', DELETE, 'D')} AS e, {after('s', ('e',), None)}, {after('u', ('e', 's', 'ca'), 'user')}, {after('a', ('cu',), 'assistant')}
  FROM (SELECT *, {least('a', insert('cu', 'assistant'))} AS ca
        FROM (SELECT dp.cid, n.rn, e, s, u, a, fault, initial, role, text, {least('u', insert('e', 'user'), insert('s', 'user'), insert('a', 'user'))} AS cu
              FROM dp JOIN numbered n ON n.cid = dp.cid AND n.rn = dp.rn + 1))),
counts AS (
  SELECT cid, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM numbered GROUP BY cid),
ends AS (
  SELECT cid, {least('e', 'a', insert('cu', 'assistant'))} AS w
  FROM (SELECT dp.cid, e, a, {least('u', insert('e', 'user'), insert('s', 'user'), insert('a', 'user'))} AS cu
        FROM dp LEFT JOIN counts USING (cid) WHERE dp.rn = coalesce(counts.n, 0)))
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, w.c AS cost, w.a AS audit, sha256(w.o) AS repaired_sha256
FROM ids JOIN ends USING (cid) LEFT JOIN counts USING (cid)
"""


ORACLE_SQL = _oracle()
