"""Table schemas of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


DOCUMENT = _struct(
    doc_id=_L, source=_S, source_path=_S, filename=_S, filetype=_S, text=_S,
    metadata=T.MapType(_S, _S),
)
CHUNK = _struct(doc_id=_L, chunk_idx=_L, chunk_id=_S, language=_S, text=_S, n_words=_L)
VECTOR = T.ArrayType(T.FloatType())
TOOL_CALL = _struct(id=_S, name=_S, args=T.MapType(_S, _S))
MESSAGE = _struct(
    thread_id=_L, turn=_L, msg_id=_S, role=_S, text=_S,
    tool_calls=T.ArrayType(TOOL_CALL), tool_call_id=_S,
)
CHECKPOINT = _struct(
    thread_id=_L, step=_L, checkpoint_id=_S, parent_id=_S,
    state=_struct(n_messages=_L, last_role=_S),
)
EDGE = _struct(src=_S, dst=_S)
SLIDE_ELEMENT = _struct(
    content=_S,
    metadata=_struct(category_depth=T.IntegerType(), page_number=T.IntegerType(), category=_S),
)
SUMMARY_ENTRY = _struct(summary=_S)
SUMMARY_MAP = T.MapType(_S, SUMMARY_ENTRY)
_LEAF = _struct(path=_S, summary=_S)
_FOLDER = _struct(path=_S, summary=_S, children=T.ArrayType(_LEAF))
SUMMARY_TREE = _struct(path=_S, summary=_S, children=T.ArrayType(_FOLDER))
REVIEW = _struct(
    summary=_S, soundness=_L, presentation=_L, contribution=_L, strengths=_S, weaknesses=_S,
    questions=_S, flag_for_ethics_review=T.ArrayType(_S), rating=_D, confidence=_D,
    code_of_conduct=_S,
)
SUBMISSION = _struct(
    submission_id=_S, title=_S, authors=T.ArrayType(_S), submission_date=_S, abstract=_S,
    reviews=T.ArrayType(REVIEW), metareview=_S, decision=_S, pdf=_S, json=_S,
    comments=_struct(
        author=T.ArrayType(_S),
        reviewer=T.ArrayType(_struct(title=_S, comment=_S)),
    ),
)
MEDIA_STREAM = _struct(
    codec_name=_S, width=_L, height=_L, r_frame_rate=_S, sample_aspect_ratio=_S,
    display_aspect_ratio=_S, color_space=_S,
)
MEDIA = _struct(streams=T.ArrayType(MEDIA_STREAM), format=_struct(format_name=_S, duration=_S))
WEATHER = _struct(
    status=_L, message=_S, weather=T.ArrayType(_struct(description=_S)),
    main=_struct(temp=_S, humidity=_S), wind=_struct(speed=_S),
)
