"""Readers for populations, file trees, attempt logs, requests, responses and checklists."""
