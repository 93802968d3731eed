"""Readers (fixture tables, `;`-separated text) and sinks."""
