"""inkmill.plans"""
