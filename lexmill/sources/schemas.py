"""Fixed schemas of what is read and written."""

from __future__ import annotations

METADATA = (
    "law_id string, law_mst string, law_title string, jurisdiction string, legal_hierarchy string, document_type string, article string, article_title string, "
    "subunit string, enforce_date string, promulgate_date string, status string, source string, attachment_no string, parse_note string, "
    "delegating_articles array<string>, associated_attachments array<string>, referenced_forms array<string>"
)
CHUNK = f"chunk_id string, content string, metadata struct<{', '.join(f.replace(' ', ': ', 1) for f in METADATA.split(', '))}>"
CORRECTION = "reason string, source_format string, date string, rules array<struct<find: string, replace: string, expect: int>>"
MEMBER = "family string, name string, type string, law_id string, tier string, why string, watch array<string>"
RULE = "name string, admrule_id string, kind string, agency string, parent string"
#: XML tag of each feed column (fixed values).
FEED = {
    "법령ID": "law_id", "법령일련번호": "mst", "공포일자": "promulgate_date", "시행일자": "enforce_date", "현행연혁코드": "status", "제개정구분명": "revision_class",
    "법령명한글": "name", "법령약칭명": "short_name", "공포번호": "promulgate_no", "소관부처코드": "ministry_code", "소관부처명": "ministry_name", "법령구분명": "class", "법령상세링크": "link",
}
