"""Message payloads to codes; works on batches and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The payload event that carries a message, and the code format.
MESSAGE_EVENT = "SMS"
CODE_LENGTH = 6
_RESULT = "caller_did string, text string"


def message_codes(payloads: DataFrame, event: str = "event", result: str = "result") -> DataFrame:
    """Payload rows as ``phone`` and ``otp_code``; other rows are left out.

    The code is the first six characters of the message text, if all are digits.
    """
    parsed = payloads.where(F.col(event) == MESSAGE_EVENT).withColumn("_r", F.from_json(result, _RESULT))
    code = F.substring(F.col("_r.text"), 1, CODE_LENGTH)
    coded = parsed.where(code.rlike(f"^[0-9]{{1,{CODE_LENGTH}}}$"))
    others = [c for c in payloads.columns if c not in (event, result)]
    return coded.select(*others, F.col("_r.caller_did").alias("phone"), code.alias("otp_code"))
