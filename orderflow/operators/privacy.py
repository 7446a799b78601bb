"""Personal columns encrypted, and read back on request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orderflow.functions.privacy import decrypt, encrypt, stable_id
from orderflow.operators.shape import column

ENCRYPTED_MOBILE = "Encrypted_Mobile_Number"


def protect(df: DataFrame, columns: Sequence[str], key: str, iv: str, mobile: str = "Mobile_Number",
            random_iv: bool = False) -> DataFrame:
    """Encrypts ``columns`` in place, adds the encrypted number and the customer id, drops the plain number.

    ``random_iv`` hides equality in ``columns``; the number always uses the fixed
    vector, because state tables are joined on it.
    """
    sealed = df.withColumn(ENCRYPTED_MOBILE, encrypt(column(mobile), key, iv))
    return (sealed.withColumns({c: encrypt(column(c), key, None if random_iv else iv) for c in columns}
                               | {"Customer_Id": stable_id(F.col(ENCRYPTED_MOBILE))})
            .drop(mobile))


def reveal(df: DataFrame, columns: Sequence[str], key: str, iv: str | None, prefix: str = "Decrypted_") -> DataFrame:
    """Adds decrypted copies of ``columns``. Only for an audit that asks for them."""
    return df.withColumns({prefix + c: decrypt(column(c), key, iv) for c in columns})
