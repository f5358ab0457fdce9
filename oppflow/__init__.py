"""Opportunity analytics as Spark jobs: landed feeds in, tables out."""
