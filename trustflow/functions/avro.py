"""Column-at-a-time Avro datum decoder for flat records.

Used when the bytes consumed must be known (trailing-byte check) or the Avro package is
not on the classpath. Every step works on a whole Arrow batch with numpy; the position
of each row moves forward field by field, so no Python code runs per row.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustflow.contract import Contract

DECODED, FAILED, TRAILING = 0, 1, 2
# Microseconds of year 1 and of the end of year 9999.
MIN_MICROS, MAX_MICROS = -62135596800000000, 253402300799999999
MAX_VARINT_BYTES = 10


class _Cursor:
    """Read position of every row in one batch of binary values."""

    def __init__(self, values: pa.Array):
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        width = np.int64 if pa.types.is_large_binary(values.type) else np.int32
        n = len(values)
        _, offsets, data = values.buffers()
        bounds = np.frombuffer(offsets, dtype=width)[values.offset : values.offset + n + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = raw if raw.size else np.zeros(1, np.uint8)
        self.pos = bounds[:-1].astype(np.int64)
        self.end = bounds[1:].astype(np.int64)
        self.null = np.asarray(values.is_null())
        self.bad = self.null.copy()

    def varint(self, wanted: np.ndarray) -> np.ndarray:
        """Zig-zag integers for the wanted rows; rows that run out of bytes become bad."""
        active = wanted & ~self.bad
        acc = np.zeros(len(self.pos), np.uint64)
        for i in range(MAX_VARINT_BYTES):
            inside = self.pos < self.end
            self.bad |= active & ~inside
            active = active & inside
            if not active.any():
                break
            byte = np.where(active, self.data[np.where(active, self.pos, 0)], 0).astype(np.uint64)
            acc |= (byte & np.uint64(0x7F)) << np.uint64(7 * i)
            self.pos += active
            active = active & (byte >= 128)
        self.bad |= active
        return (acc >> np.uint64(1)).astype(np.int64) ^ -(acc & np.uint64(1)).astype(np.int64)

    def span(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the byte string at the read position."""
        size = self.varint(wanted)
        live = wanted & ~self.bad
        self.bad |= live & ((size < 0) | (size > self.end - self.pos))
        live = wanted & ~self.bad
        size = np.where(live, size, 0)
        start = self.pos.copy()
        self.pos += size
        return start, size

    def take_text(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and bytes of one text field; rows that are not UTF-8 become bad."""
        offsets = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=offsets[1:])
        used = np.flatnonzero(size)
        widths = size[used]
        if len(used) and (widths == widths[0]).all():
            # Identifiers share one width: whole rows are copied instead of single bytes.
            chars = sliding_window_view(self.data, int(widths[0]))[start[used]].ravel()
        else:
            index = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
            chars = self.data[index]
        high = np.flatnonzero(chars >= 128)
        for row in np.unique(np.searchsorted(offsets, high, side="right") - 1):
            try:
                chars[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8")
            except UnicodeDecodeError:
                self.bad[row] = True
        return offsets, chars


def _text_array(offsets: np.ndarray, chars: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Arrow text column over the copied bytes; rows that are not valid are NULL."""
    if chars.size and not valid.all() and (chars >= 128).any():
        # Broken text must not stay behind NULLs either.
        chars = np.where(np.repeat(valid, np.diff(offsets)), chars, 63).astype(np.uint8)
    bitmap = np.packbits(valid, bitorder="little")
    narrow = offsets[-1] < 2**31
    return pa.Array.from_buffers(
        pa.string() if narrow else pa.large_string(),
        len(valid),
        [
            pa.py_buffer(bitmap),
            pa.py_buffer(offsets.astype(np.int32) if narrow else offsets),
            pa.py_buffer(np.ascontiguousarray(chars)),
        ],
    )


def decode_batch(values: pa.Array, fields, symbols) -> pa.StructArray:
    """Struct of (status, fields...) for a batch; timestamps stay microsecond integers.

    ``fields`` holds (name, kind, nullable) per field.
    """
    cur = _Cursor(values)
    everyone = np.ones(len(cur.pos), bool)
    found = []
    for _, kind, nullable in fields:
        present = everyone
        if nullable:
            branch = cur.varint(everyone)
            cur.bad |= ~cur.bad & (branch != 0) & (branch != 1)
            present = branch == 1
        if kind == "string":
            found.append((present, *cur.take_text(*cur.span(present))))
        else:
            number = cur.varint(present)
            live = present & ~cur.bad
            if kind == "enum":
                cur.bad |= live & ((number < 0) | (number >= len(symbols)))
            elif kind == "timestamp":
                cur.bad |= live & ((number < MIN_MICROS) | (number > MAX_MICROS))
            found.append((present, number, None))
    columns = []
    for (_, kind, _), (present, first, chars) in zip(fields, found):
        valid = present & ~cur.bad
        if kind == "string":
            columns.append(_text_array(first, chars, valid))
        elif kind == "enum":
            index = pa.array(np.where(valid, first, 0), mask=~valid)
            columns.append(pa.array(symbols, pa.string()).take(index))
        else:
            columns.append(pa.array(first, pa.int64(), mask=~valid))
    status = np.where(cur.bad, FAILED, np.where(cur.pos < cur.end, TRAILING, DECODED))
    columns.insert(0, pa.array(status.astype(np.int32), mask=cur.null))
    return pa.StructArray.from_arrays(columns, names=["status", *(n for n, _, _ in fields)])


def decoder(contract: Contract):
    """Arrow UDF: binary datum -> struct<status, fields...>. Only the datum crosses to Python."""
    fields = [(f.name, f.kind, f.nullable) for f in contract.fields]
    symbols = list(contract.event_names)
    kinds = {"timestamp": T.LongType(), "int": T.LongType()}
    out = T.StructType(
        [T.StructField("status", T.IntegerType())]
        + [T.StructField(name, kinds.get(kind, T.StringType())) for name, kind, _ in fields]
    )
    # Workers get this module's code with the task, so nothing has to be installed there.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @F.arrow_udf(out)
    def decode(values: pa.Array) -> pa.Array:
        return decode_batch(values, fields, symbols)

    return decode


def typed_event(decoded: Column, contract: Contract) -> Column:
    """Struct of contract-typed columns from the decoder output."""

    def column(f):
        raw = decoded[f.name]
        if f.kind == "timestamp":
            return F.timestamp_micros(raw).alias(f.name)
        if f.kind == "int":
            return raw.try_cast("int").alias(f.name)
        return raw.alias(f.name)

    return F.struct(*[column(f) for f in contract.fields])


def avro_package_available(spark) -> bool:
    """True when the optional spark-avro module is on the classpath."""
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.avro.AvroDataToCatalyst")
        return True
    except Exception:  # noqa: BLE001 - a py4j error wraps ClassNotFoundException
        return False


def from_avro_event(body: Column, contract: Contract) -> Column:
    """JVM decode through the optional module: NULL for a datum that cannot be read."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(body, contract.schema_json, {"mode": "PERMISSIVE"})
