"""inkmill.operators"""
