"""Relational operators over data tables and control tables."""
