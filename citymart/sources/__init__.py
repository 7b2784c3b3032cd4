"""Readers and writers: landing files, stored tables, folder listings and reports."""
