"""YAML as PyYAML's safe_load reads it, with libyaml's parser where that is installed.

Parsing is most of what a file costs. Trees of plain mappings, sequences and
scalars are built here from the parser's nodes; whatever else stands in a
document (sets, binary values, unknown tags) PyYAML builds itself. A text that
libyaml refuses is read again by PyYAML's own parser, whose verdict and words hold.
"""

from __future__ import annotations

from functools import lru_cache
from typing import Any

import yaml
from yaml.constructor import ConstructorError
from yaml.nodes import MappingNode, ScalarNode, SequenceNode

_TAG = "tag:yaml.org,2002:"
_STR, _SEQ, _MAP = (_TAG + n for n in ("str", "seq", "map"))
_FLATTENED = frozenset((_TAG + "merge", _TAG + "value"))
_SCALARS = frozenset(_TAG + n for n in ("null", "bool", "int", "float", "timestamp"))
_DEFAULTS = {ScalarNode: _STR, SequenceNode: _SEQ, MappingNode: _MAP}
_BASE = getattr(yaml, "CSafeLoader", None)


#: Levels that libyaml's recursive composer is trusted with; it has no guard of its own.
_DEEPEST = 500


class _Other(Exception):
    """A node that is left to PyYAML."""


@lru_cache(4096)
def _implicit(value: str) -> str:
    """The tag of a plain scalar."""
    known = yaml.SafeLoader.yaml_implicit_resolvers
    found = known.get(value[:1], []) + known.get(None, [])
    return next((tag for tag, pattern in found if pattern.match(value)), _STR)


if _BASE is not None:

    class _Loader(_BASE):
        def descend_resolver(self, current_node, current_index) -> None:
            """Nothing is resolved by its path."""

        def ascend_resolver(self) -> None:
            pass

        def resolve(self, kind, value, implicit) -> str:
            if kind is ScalarNode and implicit[0]:
                return _implicit(value) if len(value) < 64 else _implicit.__wrapped__(value)
            return _DEFAULTS[kind]

        def plain(self, node, built: dict[int, Any]):
            """The value of a node; one that an alias names is built once."""
            tag = node.tag
            if tag == _STR and type(node) is ScalarNode:
                return node.value
            if id(node) in built:
                return built[id(node)]
            if type(node) is MappingNode and tag == _MAP:
                if any(k.tag in _FLATTENED for k, _ in node.value):
                    self.flatten_mapping(node)
                out = built[id(node)] = {}
                for k, v in node.value:
                    key = k.value if k.tag == _STR and type(k) is ScalarNode else self.plain(k, built)
                    if type(key) in (dict, list):
                        raise ConstructorError("while constructing a mapping", node.start_mark, "found unhashable key", k.start_mark)
                    out[key] = self.plain(v, built)
                return out
            if type(node) is SequenceNode and tag == _SEQ:
                out = built[id(node)] = []
                out += [self.plain(v, built) for v in node.value]
                return out
            if type(node) is ScalarNode and tag in _SCALARS:
                return self.yaml_constructors[tag](self, node)
            raise _Other

    def _deep(text: str) -> bool:
        """Whether a text may nest deeper than the composer is trusted with; one with few openers is not looked at."""
        if sum(map(text.count, "[{-?")) < _DEEPEST and len(text) < _DEEPEST**2 // 2:
            return False
        level = 0
        for e in yaml.parse(text, _BASE):
            level += isinstance(e, yaml.CollectionStartEvent) - isinstance(e, yaml.CollectionEndEvent)
            if level > _DEEPEST:
                return True
        return False

    def _fast(text: str):
        if _deep(text):
            raise _Other
        loader = _Loader(text)
        try:
            node = loader.get_single_node()
            return None if node is None else loader.plain(node, {})
        finally:
            loader.dispose()


def safe_load(text: str):
    """What yaml.safe_load gives; a yaml.YAMLError where it raises one."""
    if _BASE is not None:
        try:
            return _fast(text)
        except (_Other, yaml.YAMLError, ValueError):
            pass
    return yaml.safe_load(text)
