"""Row types of the corpus: fetch logs, documents, sections, scores."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "b": T.BooleanType(), "d": T.DoubleType(), "t": T.TimestampType(), "a": T.ArrayType(T.StringType()), "n": T.DecimalType(12, 1)}


def _struct(spec: str) -> T.StructType:
    """Fields as ``name:type``, type by its letter in _TYPES."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split(":") for f in spec.split())])


SCALES = ("phone", "laptop", "ai")

MANIFEST = _struct("semester:s course:s unique:s title:s instructors:s cv:s syllabus:s survey:s dept:s kind:s doc_id:s href:s")
FETCH_LOG = _struct("doc_id:s ok:b sha256:s path:s bytes:i content_type:s original_filename:s is_pdf:b sample_course:s fetched_at:t error:s")
PAGE_LOG = _struct("doc_id:s ok:b url:s title:s last_updated:s chars:i sha256:s html_path:s text_path:s sample_course:s fetched_at:t error:s")
EXTRACTION_LOG = _struct("sha256:s pages:i tier:s garbled_text_layer:b chars:i chars_per_page:d text_path:s ok:b error:s")
DOCUMENTS = _struct("id:l content_sha256:s source_kind:s source_ids:a source_url:s original_filename:s byte_size:i page_count:i body:s extract_tier:s chars:i chars_per_page:n last_updated:s fetched_at:t")
SECTIONS = _struct("id:l semester_code:i semester_label:s department:s course_code:s unique_number:s section_title:s instructor:s cv_url:s document_id:l")
CODER_RECORD = _struct("document_id:l document_completeness:s coder_notes:s " + " ".join(f"{s}_score:i {s}_label:s {s}_required:b {s}_status:s {s}_evidence:a {s}_confidence:s" for s in SCALES))
POLICIES = _struct("document_id:l document_completeness:s coder_notes:s " + " ".join(f"{s}_score:i {s}_label:s {s}_evidence:s {s}_confidence:s {s}_required:b {s}_status:s" for s in SCALES) + " evidence_notes:s prompt_version:s model:s")
REJECTS = _struct("version:s problem:s")
POLICY_SAMPLE = _struct("document_id:l split:s")
