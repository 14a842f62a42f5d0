"""D1-D10 as declared Spark schemas (no inference pass at scale)."""

from pyspark.sql import types as T

ANSWERS = T.StructType([T.StructField("text", T.ArrayType(T.StringType()), True)])

SPAN_QA = T.StructType([                      # D1
    T.StructField("question", T.StringType(), True),
    T.StructField("context", T.StringType(), True),
    T.StructField("answers", ANSWERS, True),
])

SPAN_QA_V2 = T.StructType(SPAN_QA.fields + [  # D2
    T.StructField("is_impossible", T.BooleanType(), True),
])

EVIDENCE_QA = T.StructType([                  # D3: polymorphic fields as raw JSON text
    T.StructField("question", T.StringType(), True),
    T.StructField("answer", T.StructType([T.StructField("value", T.StringType(), True)]), True),
    T.StructField("entity_pages", T.StringType(), True),
    T.StructField("evidence", T.StringType(), True),
    T.StructField("search_results", T.StringType(), True),
])

CONTEXT_FIELDS = ("entity_pages", "evidence", "search_results")   # D4

RECORD = T.StructType([                       # D5
    T.StructField("instruction", T.StringType(), True),
    T.StructField("output", T.StringType(), True),
])

IDS = T.ArrayType(T.IntegerType(), containsNull=False)
TOKENIZED = T.StructType([                    # D7
    T.StructField("input_ids", IDS, True),
    T.StructField("attention_mask", IDS, True),
    T.StructField("labels", IDS, True),
])

TOKENIZED_ORIGIN = T.StructType([             # of D7 as written here: length, and where a row came from
    T.StructField("n_ids", T.IntegerType(), True),
    T.StructField("src_file", T.StringType(), True),
    T.StructField("src_block", T.LongType(), True),
])

METADATA = T.StructType([                     # D10
    T.StructField("num_total", T.LongType(), False),
    T.StructField("num_train", T.LongType(), False),
    T.StructField("num_val", T.LongType(), False),
    T.StructField("include", T.ArrayType(T.StringType()), False),
    T.StructField("seed", T.IntegerType(), False),
    T.StructField("system", T.StringType(), False),
])
