"""The token's value, and that neither key nor salt shows in plans or logs."""

import hashlib
import hmac
import os
import subprocess
import sys

KEY, SALT = "a-key-that-must-not-show", "salt-that-must-not-show"

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from propensia.functions.tokenize import stable_customer_token
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", "file://" + sys.argv[1]).config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").getOrCreate())
rows = spark.range(3).selectExpr("cast(4000 + id as string) as pan").select("pan", stable_customer_token("pan", sys.argv[2], sys.argv[3]).alias("token"))
for mode in ("extended", "formatted", "codegen", "cost"):
    rows.explain(mode)
print("TOKENS", *[r.token for r in rows.collect()])
rows.explain("formatted")
spark.stop()
"""


def test_neither_key_nor_salt_shows(scratch):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", SCRIPT, scratch, KEY, SALT], capture_output=True, text=True, timeout=300, cwd=root)
    assert out.returncode == 0, out.stderr[-2000:]
    want = [hmac.new(KEY.encode(), f"{SALT}:{4000 + i}".encode(), hashlib.sha256).hexdigest()[:32] for i in range(3)]
    tokens = next(line for line in out.stdout.splitlines() if line.startswith("TOKENS")).split()[1:]
    assert tokens == want
    key = KEY.encode().ljust(64, b"\0")
    pads = [bytes(b ^ x for b in key) for x in (0x36, 0x5C)]
    secrets = [KEY, SALT, *(p.hex() for p in pads), *(p.hex().upper() for p in pads), *(p.decode("latin-1")[:20] for p in pads)]
    (log,) = os.listdir(scratch)
    logged = open(os.path.join(scratch, log), encoding="utf-8", errors="replace").read()
    assert "SparkListenerSQLExecutionStart" in logged
    for text in (out.stdout, out.stderr, logged):
        for secret in secrets:
            assert secret not in text
