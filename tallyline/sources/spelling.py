"""Keys of JSON lines put into the spelling of a schema, in the bytes of many lines at once."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes worked on at a time; what is made of them stays in a processor's cache.
BLOCK = 1 << 19

_QUOTE, _BACKSLASH, _COLON, _SINGLE, _BRACKET, _OBJECT, _END = b'"\\:\'[{]'
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)

# What became of a line, if anything.
_RENAMED, _APART = 1, 2

# An escape in a string that is a key, and a string in single quotes.
_ESCAPED_KEY = re.compile(rb'\\.(?:[^"\\]++|\\.)*+"\s*:', re.S)
_SINGLE_QUOTED = re.compile(rb"[{,:\[]\s*'")

# What may follow the name of a field for which a key in another case can be renamed where it stands: nothing that holds
# keys of its own in text, that is an object in a string, or a number that is not written as a whole one.
_VALUES = {
    "text": rb"[^{\[\s]",
    "object": rb'[^"\s]|"\s*[^{\s\\]',
    "objects": rb'[^"\[\s]|"\s*[^\[\s\\]|\[\s*[{\]]',
    "texts": rb'[^\[{"\s]|"(?!\s*[\[\\])|\[\s*(?:(?:"(?:[^"\\]++|\\.)*+"|[\w.+-]++)\s*,?\s*)*+\]',
    "flag": rb"",
    "number": rb"-?\d++\s*[,}]|[^-\d\s+.NI]",
    "other": rb"(?!)",
}
_PLAIN = {kind: re.compile(rb"\s*:\s*(?:" + value + rb")", re.S) for kind, value in _VALUES.items()}
# First bytes of a value that settle it at a glance.
_GLANCE = {"text": b'"ntf-0123456789', "object": b"{n", "objects": b"n", "texts": b"n", "flag": bytes(range(33, 127)),
           "number": b'"ntf', "other": b""}


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, T.StringType):
        return "text"
    if isinstance(kind, T.StructType):
        return "object"
    if isinstance(kind, T.BooleanType):
        return "flag"
    if isinstance(kind, T.ArrayType):
        return {"object": "objects", "text": "texts"}.get(_kind(kind.elementType), "other")
    return "number" if isinstance(kind, (T.IntegralType, T.TimestampType)) else "other"


def _fields(kind: T.DataType) -> set[tuple[str, str]]:
    """Name and kind of each field, nested ones too."""
    if isinstance(kind, T.ArrayType):
        return _fields(kind.elementType)
    if isinstance(kind, T.StructType):
        return {(f.name, _kind(f.dataType)) for f in kind.fields}.union(*(_fields(f.dataType) for f in kind.fields))
    return set()


class Names:
    """The field names of a schema, which have to differ in more than their case."""

    def __init__(self, schema: T.StructType):
        fields = _fields(schema)
        self.names = sorted({name.encode() for name, _ in fields})
        self.kinds = [sorted(k for n, k in fields if n.encode() == name) for name in self.names]
        self.sizes = np.array([len(name) for name in self.names])
        self.lists = np.array([kinds == ["objects"] for kinds in self.kinds])
        self.glance = np.zeros((len(self.names), 256), bool)
        for n, kinds in enumerate(self.kinds):
            self.glance[n, list(set.intersection(*(set(_GLANCE[k]) for k in kinds)))] = True

    def bind(self, lines: pa.Array) -> pa.Array:
        """Per line: its text with the keys renamed, NULL if there is no key to rename, empty if it has to be taken apart."""
        whole = lines.buffers()[2]
        if whole is None:
            return pa.nulls(len(lines), lines.type)
        offset = np.int64 if pa.types.is_large_string(lines.type) else np.int32
        ends = np.frombuffer(lines.buffers()[1], offset)[lines.offset:lines.offset + len(lines) + 1].astype(np.int64)
        front = max(self.sizes.max(), 8) + 2
        text = np.concatenate([np.zeros(front, np.uint8), np.frombuffer(whole, np.uint8)[ends[0]:ends[-1]], np.zeros(8, np.uint8)])
        ends += front - ends[0]
        state = np.zeros(len(lines), np.int8)
        first = 0
        while first < len(lines):
            last = max(int(np.searchsorted(ends, ends[first] + BLOCK, "right")) - 1, first + 1)
            self._bind_block(text, ends[first:last + 1], state[first:last])
            first = last
        bound = pa.Array.from_buffers(lines.type, len(lines), [None, pa.py_buffer((ends - front).astype(offset)), pa.py_buffer(text[front:])])
        other = pc.if_else(pa.array(state == _APART), pa.scalar("", lines.type), pa.scalar(None, lines.type))
        return pc.if_else(pa.array(state == _RENAMED), bound, other)

    def _bind_block(self, text: np.ndarray, ends: np.ndarray, state: np.ndarray) -> None:
        """Renames keys in these lines of the text and marks what became of each line."""
        at, name, same = self._keys(text, ends[0], ends[-1])
        if same.all():
            return
        size = self.sizes[name]
        line = np.searchsorted(ends, at, "right") - 1
        # A key, its quotes and its colon are in one line.
        kept = (at - 1 >= ends[line]) & (at + size + 1 < ends[line + 1])
        for i in np.flatnonzero(kept & (text[at + size + 1] != _COLON)):
            kept[i] = _PLAIN["flag"].match(text, at[i] + size[i] + 1, ends[line[i] + 1]) is not None
        odd = kept & ~same
        lines = np.unique(line[odd])
        state[lines] = _RENAMED

        # Lines that hold a name in both spellings, or a value that hides or may hide keys.
        pairs = line * len(self.names) + name
        state[line[odd][np.isin(pairs[odd], pairs[kept & same])]] = _APART
        value = at + size + 2
        first, second = text[value], text[value + 1]
        plain = self.glance[name, first] | (self.lists[name] & (first == _BRACKET) & ((second == _OBJECT) | (second == _END)))
        for i in np.flatnonzero(kept & ~plain & (state[line] == _RENAMED)):
            if not all(_PLAIN[k].match(text, at[i] + size[i] + 1, ends[line[i] + 1]) for k in self.kinds[name[i]]):
                state[line[i]] = _APART
        if len(lines) and (text[ends[0]:ends[-1]] == _SINGLE).any():
            for i in lines:
                if _SINGLE_QUOTED.search(text, ends[i], ends[i + 1]):
                    state[i] = _APART
        for i, begin, end in zip(lines.tolist(), ends[lines].tolist(), ends[lines + 1].tolist()):
            if _ESCAPED_KEY.search(text, begin, end):
                state[i] = _APART

        for n in np.unique(name[odd]):
            text[at[odd & (name == n)][:, None] + np.arange(self.sizes[n])] = np.frombuffer(self.names[n], np.uint8)

    def _keys(self, text: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the names stand between quotes that a colon or space follows, which, and whether as they are declared.

        A name has no escapes, so its closing quote is a real one; so is the opening one unless a backslash is before it.
        Strings that end so are no names.
        """
        after = text[begin + 1:end + 1]
        close = begin + np.flatnonzero((text[begin:end] == _QUOTE) & ((after == _COLON) | (after <= 32)))
        # The eight bytes from each place on, as one number.
        words = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))
        last = words[close - 8] | _number(b" " * 8)
        at, name, same = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for n, word in enumerate(self.names):
            # A short name is told by the quote before it too. Case is told by one bit, which says so of letters only.
            tail = (b'"' + word)[-8:]
            unread = np.uint64(64 - 8 * len(tail))
            here = close[last >> unread == _number(tail) | _number(b" " * len(tail))] - len(word)
            here = here[(text[here - 1] == _QUOTE) & (text[here - 2] != _BACKSLASH)]
            letters = text[here[:, None] + np.arange(len(word))]
            exact = (letters == np.frombuffer(word, np.uint8)).all(axis=1)
            alike = exact.copy()
            alike[~exact] = (_LOWER[letters[~exact]] == np.frombuffer(word.lower(), np.uint8)).all(axis=1)
            at.append(here[alike])
            name.append(np.full(len(at[-1]), n))
            same.append(exact[alike])
        return np.concatenate(at), np.concatenate(name), np.concatenate(same)


def _number(word: bytes) -> np.uint64:
    return np.uint64(int.from_bytes(word, "little"))


def renamed(schema: T.StructType):
    """``Names.bind`` as a function of a text column."""
    names = Names(schema)

    @F.arrow_udf(T.StringType())
    def bind(lines: pa.Array) -> pa.Array:
        return names.bind(lines)

    return bind
