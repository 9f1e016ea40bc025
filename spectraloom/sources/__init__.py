"""Readers of sequence, spectrum and report files."""
