"""Stable customer token: first 32 hex chars of HMAC-SHA256(key, salt:pan).

Built from ``sha2``/``unhex``/``concat`` on binary columns, so the whole
computation stays in the JVM. Key pads and salt stand in a table of one row
that the expression reads as scalar subqueries: plans, ``explain()`` and event
logs name its columns and never hold their values. There is no default key.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from propensia import schemas as S
from propensia.functions.expr import col_or_name

_BLOCK = 64  # SHA-256 block size in bytes


def _pads(key: bytes) -> tuple[bytes, bytes]:
    import hashlib

    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def stable_customer_token(pan: Column | str, token_key: str | bytes, salt: str) -> Column:
    """The token of a PAN; key and salt belong to the deployment and have no default."""
    if not token_key:
        raise ValueError("stable_customer_token: the key is empty.")
    key = token_key.encode("utf-8") if isinstance(token_key, str) else token_key
    ipad, opad = _pads(key)
    row = (bytearray(ipad), bytearray(opad), f"{salt}:")
    # An RDD scan: the optimizer can't turn its values into literals.
    secret = SparkSession.active().createDataFrame([row], "ipad binary, opad binary, salt string")
    ipad_of, opad_of, salt_of = (secret.select(c).scalar() for c in ("ipad", "opad", "salt"))
    message = F.encode(F.concat(salt_of, col_or_name(pan).cast("string")), "UTF-8")
    inner = F.unhex(F.sha2(F.concat(ipad_of, message), 256))
    return F.substring(F.sha2(F.concat(opad_of, inner), 256), 1, S.TOKEN_HEX_CHARS)
