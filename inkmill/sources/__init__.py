"""inkmill.sources"""
