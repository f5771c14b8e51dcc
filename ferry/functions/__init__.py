"""Column-level building blocks: payload decode, strict JSON parse, serialize."""

from ferry.functions.decode import decode, payload_text
from ferry.functions.serialize import serialize
from ferry.functions.strict_json import STATUSES, classify

__all__ = ["STATUSES", "classify", "decode", "payload_text", "serialize"]
