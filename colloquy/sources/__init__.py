"""Readers and writers for JSON, JSONL, transcripts and versioned artefacts."""
