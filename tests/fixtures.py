"""Small tables with every column type, nulls and non-ASCII text."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T


def _schema(*columns):
    return T.StructType([T.StructField(n, t, True, {"access_type": a, "size": s}) for n, t, a, s in columns])


INT, TEXT, BOOL, DATE = T.IntegerType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()


def tables(spark):
    people = spark.createDataFrame(
        [(1, "Ada", True, "Countess", datetime(2026, 5, 28)), (2, "Grace", False, None, datetime(2026, 5, 28))],
        _schema(("id", INT, "Long Integer", 4), ("name", TEXT, "Text", 80), ("active", BOOL, "Boolean", 0), ("nickname", TEXT, "Text", 80), ("created_at", DATE, "DateTime", 8)),
    )
    typed = spark.createDataFrame(
        [
            (1, True, 127, 32000, 1000000, 1.5, 3.14159265358979, Decimal("1234.5678"), datetime(2026, 1, 15, 8, 30), "hello world", "memo content here", b"\x01\x02"),
            (2, False, 255, -32000, -1000000, -2.75, -0.001, Decimal("-99.9900"), datetime(1999, 12, 31, 23, 59, 59), "special chars !@#$%%^&*()", "line1\nline2", b""),
            (3, True, 0, 0, 0, 0.0, 0.0, Decimal("0"), datetime(1899, 12, 30), "", "", None),
        ],
        _schema(
            ("id", INT, "Long Integer", 4), ("flag", BOOL, "Boolean", 0), ("val_byte", T.ShortType(), "Byte", 1), ("val_short", T.ShortType(), "Integer", 2), ("val_long", INT, "Long Integer", 4),
            ("val_single", T.FloatType(), "Single", 4), ("val_double", T.DoubleType(), "Double", 8), ("val_currency", T.DecimalType(19, 4), "Currency", 8), ("val_datetime", DATE, "DateTime", 8),
            ("val_text", TEXT, "Text", 100), ("val_memo", TEXT, "Memo/Hyperlink", 0), ("val_bin", T.BinaryType(), "Binary", 20),
        ),
    )
    nulltest = spark.createDataFrame(
        [(1, None, None, None, None, False), (2, 42, "not null", datetime(2026, 6, 1), 99.9, True)],
        _schema(("id", INT, "Long Integer", 4), ("val_int", INT, "Long Integer", 4), ("val_text", TEXT, "Text", 100), ("val_dt", DATE, "DateTime", 8), ("val_double", T.DoubleType(), "Double", 8), ("val_bool", BOOL, "Boolean", 0)),
    )
    chinese = spark.createDataFrame(
        [(1, "张三", "这是一个中文描述", 95.5), (2, "李四", "第二条记录，包含标点符号！@#", 88.0), (3, "王五", "", 0.0), (4, "混合Mixed中English文", "日本語テスト 한국어 العربية", 77.7)],
        _schema(("id", INT, "Long Integer", 4), ("name", TEXT, "Text", 200), ("description", TEXT, "Memo/Hyperlink", 0), ("score", T.DoubleType(), "Double", 8)),
    )
    oids = ["1", "1.2.1", "1.2.1.1", "1.2.1.1.1", "1.2.1.1.1.1", "2.4.2.2", "2.4.2.2.1", "2.4.2.2.1.1", "2.4.2.2.1.1.1"]
    mib = spark.createDataFrame([(o, f"n{i}", i % 2, i) for i, o in enumerate(oids)], _schema(("oid", TEXT, "Text", 510), ("name", TEXT, "Text", 100), ("is_leaf", INT, "Long Integer", 4), ("line", INT, "Long Integer", 4)))
    return {"people": people, "typed": typed, "nulltest": nulltest, "chinese": chinese, "mib": mib}
