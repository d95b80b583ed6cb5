"""inkmill.enrich"""
